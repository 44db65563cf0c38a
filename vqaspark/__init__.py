"""vqaspark: Spark-native data preparation, scoring and evaluation for
question-answering models.

Operators are plain ``DataFrame -> DataFrame`` functions (use them with
``df.transform``); nothing is collected to the driver.
"""

from vqaspark.session import get_spark  # noqa: F401

__all__ = ["get_spark"]

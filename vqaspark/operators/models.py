"""Deterministic stand-in models for tests, oracles and benchmarks.

Real deployments pass a factory that loads a vision-language model; these
stubs have the same interface (factory() -> callable ``pandas.DataFrame ->
list[str]``) and answers that SQL can reproduce, so the prediction path can
be checked end to end.
"""

from __future__ import annotations

import pandas as pd


class FirstWordsAnswerer:
    """Answers with the first ``n_words`` words of the question.  With
    ``fail_modulo`` it raises on questions whose character length is a
    multiple of it (to exercise row-error isolation)."""

    def __init__(self, n_words: int, fail_modulo: int | None):
        self.n_words = n_words
        self.fail_modulo = fail_modulo

    def __call__(self, pdf: pd.DataFrame) -> list:
        out = []
        for q in pdf["question"]:
            if q is None:
                out.append(None)
                continue
            if self.fail_modulo and len(q) % self.fail_modulo == 0:
                raise ValueError("model failed on input")
            out.append(" ".join(q.split()[: self.n_words]))
        return out


class FirstWordsModel:
    """Factory for :class:`FirstWordsAnswerer` (picklable, cached per worker)."""

    def __init__(self, n_words: int = 3, fail_modulo: int | None = None):
        self.n_words = n_words
        self.fail_modulo = fail_modulo
        self.cache_key = f"first-words:{n_words}:{fail_modulo}"

    def __call__(self) -> FirstWordsAnswerer:
        return FirstWordsAnswerer(self.n_words, self.fail_modulo)

    def __repr__(self) -> str:
        return self.cache_key

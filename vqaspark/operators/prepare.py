"""Record construction, filters and validation (P*, M*).

Everything is a column expression over the input rows: no UDF, no
collect; Catalyst pushes the filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vqaspark.functions import text as T
from vqaspark.functions.hashing import shuffle_key

# Chat-template markers of the ChatML-style template used by
# the vision-language models the reference fine-tunes (public tokenizer
# template).  A different tokenizer = a different ChatTemplate instance.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
IMAGE_PLACEHOLDER = "<|vision_start|><|image_pad|><|vision_end|>"
DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant."


class ChatTemplate:
    """Renders ``array<struct<role, content array<struct<type,text>>>>``."""

    def __init__(self, im_start: str = IM_START, im_end: str = IM_END,
                 image_token: str = IMAGE_PLACEHOLDER,
                 default_system: str | None = DEFAULT_SYSTEM_PROMPT):
        self.im_start = im_start
        self.im_end = im_end
        self.image_token = image_token
        self.default_system = default_system

    def render(self, messages: Column, add_generation_prompt: bool = True) -> Column:
        def part(c):
            return (F.when(c["type"] == "image", F.lit(self.image_token))
                    .when(c["text"].isNotNull(), c["text"])
                    .otherwise(F.lit("")))

        def turn(m):
            return F.concat(F.lit(self.im_start), m["role"], F.lit("\n"),
                            F.array_join(F.transform(m["content"], part), ""),
                            F.lit(self.im_end + "\n"))

        body = F.array_join(F.transform(messages, turn), "")
        pieces = []
        if self.default_system is not None:
            sys_turn = f"{self.im_start}system\n{self.default_system}{self.im_end}\n"
            first_role = F.element_at(messages, 1)["role"]
            pieces.append(F.when(F.coalesce(first_role, F.lit("")) != "system",
                                 F.lit(sys_turn)).otherwise(F.lit("")))
        pieces.append(body)
        if add_generation_prompt:
            pieces.append(F.lit(f"{self.im_start}assistant\n"))
        return F.concat(*pieces)


DEFAULT_TEMPLATE = ChatTemplate()

_PART = "struct<type:string,text:string>"


def _image_part() -> Column:
    return F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"))


def _text_part(c: Column) -> Column:
    return F.struct(F.lit("text").alias("type"), c.cast("string").alias("text"))


def vqa_messages(question: Column, answer: Column | None = None) -> Column:
    """M1/M2: user turn (image + question) and, if given, the assistant turn."""
    user = F.struct(F.lit("user").alias("role"),
                    F.array(_image_part(), _text_part(question)).alias("content"))
    if answer is None:
        return F.array(user)
    assistant = F.struct(F.lit("assistant").alias("role"),
                         F.array(_text_part(answer)).alias("content"))
    return F.array(user, assistant)


def build_messages(df: DataFrame, question: str = "question", answer: str = "answer",
                   out: str = "messages") -> DataFrame:
    """M1: add the training conversation column."""
    return df.withColumn(out, vqa_messages(F.col(question), F.col(answer)))


def build_prompt_messages(df: DataFrame, question: str = "question",
                          out: str = "messages") -> DataFrame:
    """M2: inference prompt, user turn only."""
    return df.withColumn(out, vqa_messages(F.col(question)))


def render_chat(df: DataFrame, messages: str = "messages", out: str = "text",
                template: ChatTemplate = DEFAULT_TEMPLATE,
                add_generation_prompt: bool = True) -> DataFrame:
    """M3: chat-template text (``add_generation_prompt`` defaults to True, as
    the reference uses it for training text too)."""
    return df.withColumn(out, template.render(F.col(messages), add_generation_prompt))


def prepare_dataset(df: DataFrame, max_samples: int | None = None, shuffle: bool = True,
                    seed: int = 42, id_col: str = "id", image_col: str = "image_path",
                    template: ChatTemplate = DEFAULT_TEMPLATE, distributed: bool = False) -> DataFrame:
    """M5: messages -> rendered text -> seeded shuffle -> first ``max_samples``.

    ``images`` is the one-element image list; original columns are kept.  The
    rows come in the order of the seeded shuffle, (md5(seed:id), id): all of
    them by a distributed sort (``sources.ordered.store_shuffled`` stores that
    order once for many readers), or with ``max_samples`` the first n by
    ``first_n`` (a top-k, or with ``distributed`` the positional index).
    Without ``shuffle`` and ``max_samples`` they stay as they are.
    """
    msgs = vqa_messages(F.col("question"), F.col("answer"))
    img = F.col(image_col) if image_col in df.columns else F.lit(None).cast("string")
    out = (df.withColumn("images", F.array(img))
             .withColumn("text", template.render(msgs, True)))
    from vqaspark.operators.sampling import first_n
    if shuffle:
        out = out.withColumn("shuffle_key", shuffle_key(id_col, seed))
        if max_samples is not None:
            return first_n(out, max_samples, ["shuffle_key", id_col], distributed)
        return out.orderBy("shuffle_key", id_col)
    if max_samples is not None:
        return first_n(out, max_samples, [id_col], distributed)
    return out


def resolve_max_samples(max_samples: int | None) -> int | None:
    """O3: the train/distill entry points read ``max_samples or len``: None
    *and* 0 mean "all rows".  (``prepare_dataset`` itself keeps 0 = none.)"""
    return max_samples if max_samples else None


TURN_RANGE = 4096


def qa_pairs(conversations: DataFrame, key: str = "conv_id", order: str = "turn", turn_range: int = TURN_RANGE) -> DataFrame:
    """M8: a user turn followed by an assistant turn becomes (question, answer).

    Any numbering of turns will do.  A conversation is cut into ranges of
    ``turn_range`` turn numbers, ``lead`` runs inside a range, and the first row
    of each range is handed to the range before it, so that a conversation of
    any length spreads over the cluster.  Conversations within one range, as
    chat logs are, hand on nothing; which ones are longer is read from their
    numbers alone.  Turns must be unique in a conversation for a defined order;
    rows with a null conversation or turn pair with nothing.
    """
    c = (conversations.where(F.col(key).isNotNull() & F.col(order).isNotNull())
         .select(F.col(key).alias("_k"), F.col(order).alias("_o"), "role", "text",
                 F.floor(F.col(order) / F.lit(turn_range)).alias("_r")))
    spans = c.groupBy("_k").agg(F.min("_r").alias("_a"), F.max("_r").alias("_b"))
    long = spans.where("_a < _b").select("_k", "_a")
    heads = (c.join(long, "_k").where("_r > _a").groupBy("_k", "_r")
             .agg(F.min_by(F.struct("role", "text"), "_o").alias("_h"))
             .unionByName(long.select("_k", F.col("_a").alias("_r"), F.lit(None).cast("struct<role:string,text:string>").alias("_h"))))
    before = F.lag("_r").over(Window.partitionBy("_k").orderBy("_r"))            # a row per range of a long conversation
    handed = (heads.withColumn("_r", before).where(F.col("_r").isNotNull())
              .select("_k", F.lit(None).cast(c.schema["_o"].dataType).alias("_o"), "_h.role", "_h.text", "_r", F.lit(1).alias("_last")))
    turns = c.withColumn("_last", F.lit(0)).unionByName(handed)
    w = Window.partitionBy("_k", "_r").orderBy("_last", "_o")
    return (turns.select("_k", "_o", "role", "_last", F.col("text").alias("question"),
                         F.lead(F.struct("role", "text")).over(w).alias("_n"))
            .where((F.col("_last") == 0) & (F.col("role") == "user") & (F.col("_n.role") == "assistant"))
            .select(F.col("_k").alias(key), F.col("_o").alias(order), "question", F.col("_n.text").alias("answer")))


# --------------------------------------------------------------------- filters

def image_path_column(image_id: Column, filename: Column, root: str) -> Column:
    """Lookup filename, else the zero-padded ``%012d.jpg`` (Python format
    semantics: ids longer than 12 digits are kept whole, not truncated)."""
    name = F.coalesce(filename, F.format_string("%012d.jpg", image_id.cast("bigint")))
    return F.concat(F.lit(root.rstrip("/") + "/"), name)


def valid_requests(df: DataFrame, path_col: str = "image_path",
                   question_col: str = "question") -> DataFrame:
    """Drop rows whose image path or question is NULL or empty."""
    return df.where((F.col(path_col) != "") & (F.col(question_col) != ""))


def limit_then_filter(df: DataFrame, limit: int | None, order_col: str = "id") -> DataFrame:
    """The first ``limit`` requests (0/None = all) and *then* P3."""
    if limit:
        from vqaspark.operators.sampling import first_n
        df = first_n(df, int(limit), [order_col])
    return valid_requests(df)


def length_filter(df: DataFrame, max_question: int = 512, max_answer: int = 100,
                  unit: str = "chars", question_col: str = "question",
                  answer_col: str = "answer", flag_only: bool = False) -> DataFrame:
    """P10: question/answer length limits, in characters or words."""
    if unit == "chars":
        qlen, alen = F.char_length(question_col), F.char_length(answer_col)
    elif unit == "words":
        qlen, alen = T.word_count(question_col), T.word_count(answer_col)
    else:
        raise ValueError("unit must be 'chars' or 'words'")
    ok = (F.coalesce(qlen, F.lit(0)) <= max_question) & (F.coalesce(alen, F.lit(0)) <= max_answer)
    if flag_only:
        return df.withColumn("within_limits", ok)
    return df.where(ok)


def validate_text(df: DataFrame, cols=("question", "answer"), binary: bool = False) -> DataFrame:
    """Per row, is every text column present, non-blank (and, for
    binary input, valid UTF-8)?  Adds ``text_valid`` and ``text_issue``."""
    issues = []
    for c in cols:
        col = F.col(c)
        if binary:
            issues.append(F.when(~F.is_valid_utf8(col), F.lit(f"{c}:invalid_utf8")))
            col = F.try_validate_utf8(col).cast("string")
        issues.append(F.when(col.isNull(), F.lit(f"{c}:null")))
        issues.append(F.when(T.py_strip(col) == "", F.lit(f"{c}:blank")))
    issue = F.coalesce(*issues)
    return df.withColumn("text_issue", issue).withColumn("text_valid", issue.isNull())


# Leading bytes of the image formats accepted by the loader.
IMAGE_MAGIC = {
    "jpeg": "FFD8FF",
    "png": "89504E470D0A1A0A",
    "gif": "474946383",
    "bmp": "424D",
}


def _magic_format(head: Column) -> Column:
    # a RIFF container is an image only if its bytes 8-11 say WEBP
    webp = F.startswith(head, F.lit("52494646")) & (F.substring(head, 17, 8) == "57454250")
    fmt = F.when(webp, F.lit("webp"))
    for name, magic in reversed(list(IMAGE_MAGIC.items())):
        fmt = F.when(F.startswith(head, F.lit(magic)), F.lit(name)).otherwise(fmt)
    return fmt


def validate_images(listing: DataFrame, content_col: str = "content", header_only: bool = False) -> DataFrame:
    """A file is a valid image if it is non-empty and starts with a known
    magic number.  ``header_only`` takes the listing's ``header`` column
    (``image_listing(with_header=True)``: 16 bytes of each file by ranged
    reads, whatever its length; empty files are listed and invalid).  A file
    that cannot be opened fails the read: an I/O error is not an invalid
    image.  (``binaryFile`` listings skip zero-byte files.)"""
    if header_only:
        content_col = "header"
    fmt = _magic_format(F.hex(F.substring(F.col(content_col), 1, 16)))
    out = (listing.withColumn("image_format", fmt)
                  .withColumn("image_valid", (F.col("length") > 0) & fmt.isNotNull()))
    return out.drop("header") if header_only else out


def similarity_gate(scored: DataFrame, score_col: str = "rouge_l",
                    threshold: float = 0.7) -> DataFrame:
    """Keep rows whose similarity score reaches the threshold."""
    return scored.where(F.col(score_col) >= threshold)


def gate_pass_rate(scored: DataFrame, score_col: str = "rouge_l", threshold: float = 0.7) -> DataFrame:
    """How many rows the gate sees and keeps, and their share (0 for an
    empty input)."""
    kept = F.count_if(F.col(score_col) >= threshold)
    n = F.count(F.lit(1))
    return scored.agg(n.alias("num_samples"), kept.alias("num_kept"),
                      F.coalesce(kept / F.when(n > 0, n), F.lit(0.0)).alias("pass_rate"))


# ------------------------------------------------------- distillation records

def word_ids(tok: Column, vocab_size: int = 1 << 20) -> Column:
    """Default tokenizer id: first 8 hex digits of md5(word) modulo
    ``vocab_size`` (portable: any engine with md5 gives the same ids)."""
    return F.transform(tok, lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % vocab_size)


def distill_examples(df: DataFrame, teacher_col: str = "teacher_answer",
                     question_col: str = "question", max_length: int = 512,
                     pad_id: int = 0, template: ChatTemplate = DEFAULT_TEMPLATE, tokenizer=None) -> DataFrame:
    """M6: prompt (user turn, generation prompt) + teacher answer; token ids;
    labels = ids with the prompt masked to -100; padded to ``max_length`` but
    never truncated (as the reference).

    ``tokenizer`` is a factory as in ``operators.tokenize``.  The whole text is
    encoded once; tokens that begin before the prompt's last character are
    masked, so a token over the boundary counts as prompt.  Without one, words
    are the tokens, and their ids come from md5."""
    prompt = template.render(vqa_messages(F.col(question_col)), True)
    full = F.concat(prompt, F.coalesce(F.col(teacher_col), F.lit("")))
    if tokenizer is None:
        ids = word_ids(T.split_words(full))
        prompt_len = F.size(T.split_words(prompt))
        out = df.withColumn("full_text", full)
    else:
        from vqaspark.operators.tokenize import tokenize
        out = tokenize(df.withColumn("full_text", full).withColumn("_prompt_chars", F.char_length(prompt)), "full_text", tokenizer,
                       "_tokens", "_prompt_chars").drop("_prompt_chars")
        ids, prompt_len = F.col("_tokens.ids").cast("array<bigint>"), F.col("_tokens.n_prefix")
    pad = F.greatest(F.lit(0), F.lit(max_length) - F.size(ids))
    # no lambda: a per-row value inside one would be re-evaluated per token
    labels = F.concat(F.array_repeat(F.lit(-100).cast("bigint"), F.least(prompt_len, F.size(ids))),
                      F.slice(ids, prompt_len + 1, F.greatest(F.size(ids) - prompt_len, F.lit(0))))
    return (out.withColumn("prompt_len", prompt_len)
              .withColumn("input_ids", F.concat(ids, F.array_repeat(F.lit(pad_id).cast("bigint"), pad)))
              .withColumn("labels", F.concat(labels, F.array_repeat(F.lit(-100).cast("bigint"), pad)))
              .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), F.size(ids)),
                                                     F.array_repeat(F.lit(0), pad))).drop("_tokens"))

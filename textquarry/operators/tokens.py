"""Token lists: encoding, template fitting and loss masks."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.text import PRETOKEN, pretokens, words


def tokenize(
    df: DataFrame,
    text: str = "text",
    into: str = "tokens",
    pattern: str = PRETOKEN,
    encode: Callable[[Column], Column] | None = None,
    eod: str | None = "</s>",
) -> DataFrame:
    """Token list and length per document; documents without a token are dropped.

    By default the split pattern runs in the JVM. ``encode`` swaps in any column
    function, for instance one made by :func:`arrow_encoder`.
    """
    listed = (encode or (lambda c: pretokens(c, pattern)))(F.col(text))
    out = df.withColumn(into, listed).where(F.size(into) > 0)
    if eod is not None:
        out = out.withColumn(into, F.array_append(into, F.lit(eod)))
    return out.withColumn("n_tokens", F.size(into))


def arrow_encoder(load: Callable[[], Callable[[str], list[int]]]) -> Callable[[Column], Column]:
    """A tokenizer library as an Arrow-batched column function; loaded once per Python worker."""
    cache: dict[str, Callable] = {}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pd.Series) -> pd.Series:
        if "f" not in cache:
            cache["f"] = load()
        return texts.map(lambda s: None if s is None else list(cache["f"](s)))

    return encode


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


def clean_unicode(df: DataFrame, text: str = "text") -> DataFrame:
    """Canonical composition (NFC), without carriage returns and NUL characters.

    Texts of plain ASCII are composed as they are: the worker gets NULL for them.
    """
    bare = F.translate(F.col(text), "\r\u0000", "")
    plain = F.octet_length(bare) == F.length(bare)
    return df.withColumn(text, F.coalesce(_nfc(F.when(~plain, bare)), bare))


def fit_template(
    df: DataFrame, parts: str, max_len: int, fields: list[str], side: str = "right",
    virtual_tokens: int = 0, tokens_to_generate: int = 0, special_tokens: int = 0,
) -> DataFrame:
    """Truncate template parts until they fit ``max_len`` tokens together.

    Virtual prompt tokens, tokens still to be generated and special tokens (start,
    separator, end) count towards the limit but are not part of the template.

    ``parts`` is an array of ``struct(key, ids)``. The excess is shared equally by
    the truncation fields (earlier fields take the remainder); what is still too
    long is taken from whole parts, starting at the given side.
    """
    max_len = max_len - virtual_tokens - tokens_to_generate - special_tokens
    if max_len < 0:
        raise ValueError("nothing is left for the template")

    def total(p: Column) -> Column:
        return F.aggregate(p, F.lit(0), lambda a, x: a + F.size(x["ids"]))

    def cut(ids: Column, n: Column) -> Column:
        keep = F.greatest(F.size(ids) - n, F.lit(0))
        return F.slice(ids, F.lit(1), keep) if side == "right" else F.slice(ids, F.size(ids) - keep + 1, keep)

    p = F.col(parts)
    excess = F.greatest(total(p) - max_len, F.lit(0))
    if fields:
        share, extra = F.floor(excess / len(fields)).cast("int"), excess % len(fields)
        order = F.transform(F.filter(p, lambda x: x["key"].isin(*fields)), lambda x: x["key"])

        def shortened(x: Column) -> Column:
            rank = F.array_position(order, x["key"]).cast("int") - 1
            quota = F.when(rank >= 0, share + F.when(rank < extra, 1).otherwise(0)).otherwise(0)
            return F.struct(x["key"].alias("key"), cut(x["ids"], quota).alias("ids"))

        p = F.transform(p, shortened)
    df = df.withColumn(parts, p)

    # The remaining excess: take from each part what the parts before it (from the side) left over.
    p = F.col(parts)
    rest = F.greatest(total(p) - max_len, F.lit(0))

    def taken(x: Column, i: Column) -> Column:
        nearer = F.slice(p, F.lit(1), i) if side == "left" else F.slice(p, i + 2, F.size(p))
        mine = F.least(F.size(x["ids"]), F.greatest(rest - total(nearer), F.lit(0)))
        return F.struct(x["key"].alias("key"), cut(x["ids"], mine).alias("ids"))

    return df.withColumn(parts, F.transform(p, taken))


def answer_loss_mask(ids: Column, answer_start: Column) -> Column:
    """1 from the start of the answer on, 0 before."""
    return F.transform(ids, lambda _, i: F.when(i >= answer_start, 1).otherwise(0))


def role_loss_mask(messages: Column, role: str = "assistant") -> Column:
    """One entry per token of the conversation: 1 in the turns of ``role``."""
    return F.flatten(
        F.transform(
            messages,
            lambda m: F.array_repeat(F.when(m["role"] == role, 1).otherwise(0), F.size(words(m["content"]))),
        )
    )

"""Token counts with a whole-token shortcut.

A piece vocabulary whose pieces carry the word mark only in front cannot merge
across the start of a word, so a text's count is the sum over its pre-tokens (a
run of spaces and the word after it). Which vocabulary strings encode alone as
exactly one token is proved once, before the job; such pre-tokens count as one
by a table lookup, and only the rest are merged by the tokenizer, each distinct
string once per stretch of a task.

Defined cases: null and empty texts have 0 tokens; a literal word mark in a
text is a space, as the tokenizer has it; runs of spaces stay one pre-token
with the word after them; repeated rows count alike; other columns pass
through untouched, and an existing column of the output's name is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Distinct pre-tokens remembered by a task before it starts afresh.
MEMO = 400_000
PRE_TOKEN = re.compile(" ( *[^ ]*)")


def whole_tokens(model_path: str) -> list[str]:
    """Words proved to encode alone as one token; raises if merges may cross words."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("the vocabulary has pieces that cross the start of a word")
    if sp.encode(f"a{MARK}b c") != sp.encode("a b c") or sp.encode(" a") == sp.encode("a"):
        raise ValueError("the model changes spaces; pre-tokens cannot be counted alone")
    alone = [p[1:] for p in pieces if len(p) > 1 and p[0] == MARK and MARK not in p[1:]]
    return [w for w, ids in zip(alone, sp.encode(alone)) if len(ids) == 1]


def pre_tokens(text: str) -> list[str]:
    """What follows each word start: the word, after any further spaces."""
    spaced = " " + text.replace(MARK, " ")
    if "  " in spaced or spaced[-1] == " ":
        return PRE_TOKEN.findall(spaced)
    return spaced.split(" ")[1:]


def token_counter(model_path: str, known: list[str]):
    """A function of a text that gives its number of tokens."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    # A lone closing space is the mark itself, which is a piece of its own.
    whole = dict.fromkeys(known, 1) | {"": len(sp.encode("a ")) - len(sp.encode("a"))}
    memo = dict(whole)

    def count(text: str | None) -> int:
        nonlocal memo
        if not text:
            return 0
        parts = pre_tokens(text)
        new = [p for p in set(parts) if p not in memo]
        if new:
            if len(memo) > MEMO:
                memo = dict(whole)
                new = [p for p in set(parts) if p not in memo]
            memo.update(zip(new, map(len, sp.encode(new, num_threads=1))))
        return sum(map(memo.__getitem__, parts))

    return count


def token_count(text: Column, model_path: str) -> Column:
    """Number of tokens of ``text``, as a column."""
    known = whole_tokens(model_path)

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = token_counter(model_path, known)
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    return counted(text)


def with_token_counts(
    docs: DataFrame, model_path: str, text: str = "text", limit: int = 4096,
    n_bytes: str = "n_bytes", n_tokens: str = "n_tokens", over_limit: str = "over_limit",
) -> DataFrame:
    """``docs`` with the bytes and tokens of each text and whether it exceeds ``limit`` tokens."""
    return (
        docs.withColumn(n_bytes, F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"))
        .withColumn(n_tokens, token_count(F.col(text), model_path))
        .withColumn(over_limit, F.col(n_tokens) > limit)
    )

"""Sum-of-squares packing of tokenized documents into sequences.

``piece_tokens`` turns documents into pieces of at most ``capacity`` token ids.
``pack`` deals the pieces at random to groups of bounded size and places each
one where the sum of the squared counts of open bins per residual gap becomes
smallest. What a group leaves in bins that did not fill up is packed again
over fewer groups, so the loss of grouping does not add up.

Defined cases: a null or empty text has only the closing id; a document longer
than ``capacity`` is cut into full pieces and a last one that may be shorter;
repeated rows are packed each; ties between bins go to the smallest gap; an
empty table gives no rows. Other columns of the pieces pass through; clashing
names of the output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import release_memory, settled

#: Texts that the tokenizer's rules split into letters, single digits and runs of
#: other marks: Latin letters with one lower case, no apostrophe, no special token.
PLAIN = "^[ -&(-~\nÀ-ÖØ-öø-ÿ]*$"
MARKS = "[0-9]|[!-&(-/:-@\\[-`{-~]+"
SPECIAL = "<|"
#: Distinct strings remembered by a task before it starts afresh.
MEMO = 700_000
#: Pieces that one task packs at a time.
GROUP = 12_000
#: Bins with a larger gap than this are packed again.
LOOSE = 16


def encoder(path: str):
    """A function that gives the token ids of a text as little-endian 32-bit bytes.

    Plain texts are split into pre-tokens, others at spaces and line feeds, which
    lie in no token; each distinct part is encoded once, alone.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    closing = {i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>")}
    ends = np.zeros(max(closing | {0}) + 1, dtype=bool)
    ends[list(closing)] = True
    memo: dict[str, bytes] = {"": b""}

    def alone(some: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def together(some: list[str]) -> list[bytes]:
        # Each part is one pre-token and so ends with the only closing token in it.
        ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(ends[np.minimum(ids, len(ends) - 1)]) + 1
        if len(cuts) != len(some) or cuts[-1] != len(ids):
            return alone(some)
        raw, bounds = ids.tobytes(), (cuts * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *bounds], bounds)]

    def learn(parts: list[str], one_pre_token: bool) -> None:
        new = [p for p in parts if p not in memo]
        if not one_pre_token:
            memo.update(zip(new, alone(new)))
            return
        for i in range(0, len(new), 200):
            some = new[i : i + 200]
            memo.update(zip(some, together(some)))

    def plain_ids(texts: pa.StringArray) -> list[bytes]:
        # Marks get spaces around them, so that what stands between spaces is a pre-token.
        spaced = pc.replace_substring_regex(pc.utf8_lower(texts), pattern=f"({MARKS})", replacement=" \\1 ")
        words = pc.ascii_split_whitespace(spaced)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        learn(distinct, True)
        ids_of = [memo[w] for w in distinct]
        size = np.array([len(x) // 4 for x in ids_of], np.int32)
        flat, begin = np.frombuffer(b"".join(ids_of), "<u4"), np.cumsum(size, dtype=np.int32) - size
        code = coded.indices.to_numpy(zero_copy_only=False)
        sizes = size[code]
        ends = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
        ids = flat[np.arange(ends[-1], dtype=np.int32) + np.repeat(begin[code] - ends[:-1], sizes)]
        bounds = ends[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def encode(texts: pa.StringArray) -> list[bytes]:
        if len(memo) > MEMO:
            memo.clear()
            memo[""] = b""
        special = pc.match_substring(texts, SPECIAL)
        plain = pc.fill_null(pc.and_not(pc.match_substring_regex(texts, PLAIN), special), False).to_numpy(zero_copy_only=False)
        out = [b""] * len(texts)
        at = np.flatnonzero(plain)
        if len(at):
            for i, ids in zip(at.tolist(), plain_ids(texts.take(pa.array(at)))):
                out[i] = ids
        for i in np.flatnonzero(~plain).tolist():
            chunks = (texts[i].as_py() or "").replace("\n", " ").split(" ")
            learn(list(set(chunks)), False)
            out[i] = b"".join(map(memo.__getitem__, chunks))
        return out

    return encode


def piece_tokens(
    docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
    capacity: int = 2048, closing_id: int = 0,
) -> DataFrame:
    """Pieces of the documents: id, piece, start, length and ids (little-endian 32-bit)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    step = capacity * 4

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        last = np.array([closing_id], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 800):
                some = batch.slice(at, 800)
                rows, piece, start, length, ids = [], [], [], [], []
                for row, got in enumerate(encode(some.column(1))):
                    got += last
                    for k, begin in enumerate(range(0, len(got), step)):
                        rows.append(row)
                        piece.append(k)
                        start.append(begin // 4)
                        ids.append(got[begin : begin + step])
                        length.append(len(ids[-1]) // 4)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )
            release_memory()
        del encode
        release_memory()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and the bin's last gap for each length, in the order given.

    Only the number of open bins per gap decides: a length s that goes to a bin
    of gap g takes one from count g and adds one to count g - s.
    """
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    gap_of: list[int] = []
    for i, s in enumerate(lengths.tolist()):
        if s >= capacity:
            bins[i] = len(gap_of)
            gap_of.append(0)
            continue
        # Halved change of the sum of squares: fill exactly, move s..capacity-1, or open a bin.
        change = count[: capacity - s] - count[s:capacity] + 1.0
        change[0] = 0.5 - count[s]
        change[count[s:capacity] == 0] = np.inf
        g = int(np.argmin(change)) + s
        if change[g - s] <= count[capacity - s] + 0.5:
            b = open_bins[g].pop()
            count[g] -= 1
        else:
            g, b = capacity, len(gap_of)
            gap_of.append(capacity)
        bins[i], offsets[i] = b, capacity - g
        gap_of[b] = g - s
        if g > s:
            open_bins[g - s].append(b)
            count[g - s] += 1
    return bins, offsets, np.array(gap_of, np.int64)[bins] if n else bins


def placer(length: str, capacity: int, base: int):
    """Task function that packs one group; its sequences are numbered from ``base`` + group."""

    def placed(rows: pa.Table) -> pa.Table:
        # Longest first, in random order among equals: short ones fill the gaps that long ones leave.
        rows = rows.sort_by([(length, "descending"), ("_at", "ascending")])
        bins, offsets, gaps = sum_of_squares(rows[length].to_numpy(), capacity)
        bins += (base + rows["_group"][0].as_py()) << 32
        for name, values in (("sequence_id", bins), ("offset", offsets), ("_gap", gaps)):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        return rows

    return placed


def pack(pieces: DataFrame, capacity: int = 2048, length: str = "length", group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` should be written or settled rows.

    The pieces' place in the random order is drawn once and settled, so a task
    that runs again deals the same rows to the same groups.
    """
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    left = settled(pieces.withColumn("_at", F.rand(17)))
    done, base = None, 0
    for last in (False, True):
        groups = max(1, math.ceil(left.count() / group))
        grouped = left.withColumn("_group", F.least(F.floor(F.col("_at") * groups), F.lit(groups - 1)).cast("long"))
        kind = grouped.select("*", *(F.lit(0).cast("long").alias(c) for c in ("sequence_id", "offset", "_gap"))).schema

        packed = settled(grouped.groupBy("_group").applyInArrow(placer(length, capacity, base), kind))
        loose = F.col("_gap") > LOOSE
        kept = (packed if last else packed.filter(~loose)).select(*names, "sequence_id", "offset")
        done = kept if done is None else done.unionByName(kept)
        left = packed.filter(loose).select(*names, "_at")
        base += groups
    return done

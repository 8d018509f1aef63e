"""Problem 10: long exact spans shared between texts, by hashing runs of consecutive sentences.

Where a run starts depends only on nearby characters: at sentence starts, and within a sentence longer than LONG at the
least 16-gram of every window (so no stretch goes without a start). A run takes the sentences that fill RUN characters,
its last sentence cut there. Any span of MIN_SPAN characters two texts share then holds a run that starts and reads
alike in both: the first start common to both lies within LONG + 2 characters of the span's begin, and LONG + 2 + RUN
is less than MIN_SPAN. So equal runs are a complete set of candidates. Around each, every stretch of MIN_SPAN characters
is hashed, and equal stretches meet by their hash: no pair of texts is formed to find what is shared, and no text is
copied for one. Holders of a stretch are a class; a text many others share passages with is in as many classes as it has
sets of partners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encode import _kept
from tidemark.llm.pretokens import slices
from tidemark.session import cut

MIN_SPAN, RUN, LONG, WINDOW, GRAM = 300, 184, 110, 94, 16
#: Members of a class that are paired with all others by one task.
BLOCK = 2048
#: Said outright, for a join would add it to one use of an exchange only.
WHOLE = "hash is not null and doc_id is not null"
BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as long as the longest slice so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2_100_000)
            with np.errstate(over="ignore"):
                self.up = _powers(BASE, size)
                self.down = _powers(pow(BASE, -1, 1 << 64), size)
        return self.up, self.down


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of any stretch of a sequence of code points in constant time."""

    def __init__(self, cp: np.ndarray) -> None:
        up, self.down = _kept("powers", _Powers).reach(len(cp) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(cp.astype(np.uint64) + np.uint64(1)) * up[: len(cp)], dtype=np.uint64)])

    def of(self, at: np.ndarray, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[at + length] - self.sums[at]) * self.down[at])


def _in(cp: np.ndarray, chars: str) -> np.ndarray:
    out = np.zeros(len(cp), bool)
    for c in chars:
        out |= cp == ord(c)
    return out


def run_starts(cp: np.ndarray, begins: np.ndarray, ends: np.ndarray, roll: Rolling) -> np.ndarray:
    """Where runs start in texts laid end to end (``begins`` and ``ends`` of each, in characters)."""
    n = len(cp)
    head = np.zeros(n, bool)
    head[1:] = _in(cp[:-1], "\n。！？")
    head[2:] |= (cp[1:-1] == ord(" ")) & _in(cp[:-2], ".!?…")
    head[begins[begins < n]] = True
    starts = np.flatnonzero(head)
    stops = np.append(starts[1:], n)
    long = stops - starts > LONG
    if long.any() and n > WINDOW + GRAM:
        grams = np.arange(n - GRAM + 1)
        key = (roll.of(grams, GRAM) & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - grams.astype(np.uint64))
        least, width = key, 1
        while width * 2 <= WINDOW:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        least = np.minimum(least[: len(least) - (WINDOW - width)], least[WINDOW - width :])
        count = stops[long] - starts[long] - (WINDOW + GRAM - 2)
        first = np.repeat(starts[long] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        picked = np.uint64(0xFFFFFFFF) - (least[first] & np.uint64(0xFFFFFFFF))
        head[picked.astype(np.int64)] = True
        starts = np.flatnonzero(head)
    stop_of = ends[np.searchsorted(begins, starts, "right") - 1]
    return starts[starts + RUN <= stop_of]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, pos, hash) of every run of texts long enough to share a span."""
    for batch in batches:
        ids, at = batch.column(0), 0
        for data, stop in slices(batch.column(1)):
            cp = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
            width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
            ends = np.searchsorted(np.cumsum(width), stop, "left") + 1
            begins = np.concatenate([[0], ends[:-1]])
            roll = Rolling(cp)
            starts = run_starts(cp, begins, ends, roll)
            owner = np.searchsorted(begins, starts, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, len(stop)).take(pa.array(owner)), pa.array((starts - begins[owner]).astype(np.int32)), pa.array(roll.of(starts, RUN).view(np.int64))], names=["doc_id", "pos", "hash"]
            )
            at += len(stop)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, at, hash) of every stretch of MIN_SPAN characters that holds one of the given runs."""
    for batch in batches:
        for r in batch.to_pylist():
            cp = np.frombuffer(r["text"].encode("utf-32-le"), np.uint32)
            pos = np.array(r["spots"], np.int64)
            at = np.unique((pos[:, None] - np.arange(MIN_SPAN - RUN + 1)[None, :]).ravel())
            at = at[(at >= 0) & (at + MIN_SPAN <= len(cp))]
            same = pa.array([r["doc_id"]] * len(at), batch.schema.field("doc_id").type)
            yield pa.RecordBatch.from_arrays([same, pa.array(at.astype(np.int32)), pa.array(Rolling(cp).of(at, MIN_SPAN).view(np.int64))], names=["doc_id", "at", "hash"])


def _dealt_stretches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(hash, doc_id, at) of every stretch around a run that other texts hold too, dealt by hash.

    Both what is counted and what is kept of the runs comes from one exchange, which Spark reuses where the two plans are
    alike; so the count looks at all columns, and nothing has to be written twice.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("doc_id").isNotNull() & (F.length("text") >= MIN_SPAN))
    kind = dict(own.dtypes)["doc_id"]
    runs = own.mapInArrow(_runs, f"doc_id {kind}, pos int, hash bigint").filter(WHOLE).repartition("hash")
    repeated = runs.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max("pos").alias("last")).filter("lo != hi or last < 0").select("hash")
    spots = runs.join(repeated, "hash").groupBy("doc_id").agg(F.collect_set("pos").alias("spots"))
    return own.join(spots, "doc_id").select("doc_id", "text", "spots").mapInArrow(_windows, f"doc_id {kind}, at int, hash bigint").filter(WHOLE)


def shared_stretches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(hash, doc_id, at, lo): every stretch of MIN_SPAN characters that another text has too, ``lo`` being the least id that has it.

    Complete: a longer common span is the union of its stretches. Null ids and null or shorter texts share nothing.
    """
    dealt = _dealt_stretches(docs, doc_id, text).repartition("hash")
    alike = dealt.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max("at").alias("last")).filter("lo != hi or last < 0")
    return dealt.join(alike.select("hash", "lo"), "hash")


def sharing_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(class_id, doc_id, members): the texts that share a stretch, one class for each different set of texts, however many stretches it shares.

    Any two texts of a class share a span, and any two that do are in a class together; a class lists its members, not
    its pairs.
    """
    holders = _dealt_stretches(docs, doc_id, text).select("hash", "doc_id").repartition("hash").distinct()
    mark = F.xxhash64("doc_id")
    sets = holders.groupBy("hash").agg(F.count("*").alias("members"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("y")).filter("members > 1")
    chosen = sets.groupBy("members", "x", "y").agg(F.min("hash").alias("hash")).select("hash", "members")
    return cut(holders.join(chosen, "hash").select(F.col("hash").alias("class_id"), "doc_id", "members"))


def pairs_of(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id_a < doc_id_b of every two members of a class; no pair twice.

    A class is split into blocks of about ``block`` members, and each block meets the whole class in a task of its own, so a
    class that holds a third of all texts is shared out.
    """
    blocks = F.ceil(F.col("members") / block).cast("int")
    left = classes.select("class_id", F.col("doc_id").alias("doc_id_a"), F.pmod(F.xxhash64("doc_id"), blocks).cast("int").alias("block"))
    right = classes.select("class_id", F.col("doc_id").alias("doc_id_b"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    return left.join(right, ["class_id", "block"]).filter("doc_id_a < doc_id_b").select("doc_id_a", "doc_id_b").distinct()


def sharing_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id_a < doc_id_b of every two texts with a common span of MIN_SPAN characters; no pair twice.

    Pairs are what is asked for here, so their number is that of the answer: a passage that k texts share gives k (k - 1) / 2.
    """
    return pairs_of(sharing_classes(docs, doc_id, text), block)


def _covered(parts: DataFrame) -> DataFrame:
    """(doc_id, chars): how many characters of each text its stretches (at, stop) cover together."""
    order = Window.partitionBy("doc_id").orderBy("at", "stop")
    before = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    new = parts.distinct().withColumn("new", F.greatest(F.lit(0), F.col("stop") - F.greatest("at", before)))
    return new.groupBy("doc_id").agg(F.sum("new").alias("chars"))


def shared_share(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, shared_chars, shared_share of every row: how much of its text also stands in other texts.

    Null and empty texts have 0 characters, 0 shared and a share of 0; a null id shares nothing.
    """
    covered = _covered(shared_stretches(docs, doc_id, text).select("doc_id", "at", (F.col("at") + MIN_SPAN).alias("stop")))
    every = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.length(text), F.lit(0)).alias("n_chars"))
    out = every.join(covered, "doc_id", "left").withColumn("shared_chars", F.coalesce("chars", F.lit(0)))
    share = F.when(F.col("n_chars") > 0, F.round(F.col("shared_chars") / F.col("n_chars"), 6)).otherwise(F.lit(0.0))
    return out.select("doc_id", "n_chars", "shared_chars", share.alias("shared_share"))


def _drop_sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import re

    sentence = re.compile(r"[^\n。！？]*?(?:[.!?…] |[\n。！？]|\Z)")
    for batch in batches:
        kept = []
        for text, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if not parts or not text:
                kept.append(text)
                continue
            gone = np.zeros(len(text) + 1, np.int64)
            for p in parts:
                gone[p["at"]] += 1
                gone[p["stop"]] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            kept.append("".join(m.group() for m in sentence.finditer(text) if m.group() and not gone[m.start() : m.end()].all()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["doc_id", "text"])


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text of every row, less the sentences that lie wholly in a span some text with a smaller id has too.

    Null texts and texts that repeat nothing come unchanged.
    """
    later = shared_stretches(docs, doc_id, text).filter("doc_id != lo").select("doc_id", "at", (F.col("at") + MIN_SPAN).alias("stop"))
    parts = later.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("at", "stop")).alias("parts"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(parts, "doc_id", "left")
    return own.mapInArrow(_drop_sentences, f"doc_id {dict(docs.dtypes)[doc_id]}, text string")

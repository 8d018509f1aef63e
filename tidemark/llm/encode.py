"""Problem 8: the whole corpus as token ids, by a transducer lexicon of frequent words and exact merges of the others."""

from __future__ import annotations

import base64
import hashlib
import sys
import types
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.lexicon import MAX_WORD_BYTES, Lexicon, compile_lexicon
from tidemark.llm.pretokens import character_classes, lay_out, slices
from tidemark.session import cut, shared_folder

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEXICON_WORDS = 65_536
CACHE_WORDS, FLUSH_WORDS = 400_000, 400_000


def _worker_state() -> types.ModuleType:
    """What a Python worker keeps between tasks; functions travel by value, so module globals would not last."""
    return sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker"))


def _kept(name: str, make: Callable):
    state = _worker_state()
    if not hasattr(state, name):
        setattr(state, name, make())
    return getattr(state, name)


def load_merger(path: str) -> Callable[[bytes], list[int]]:
    """A function from one word's bytes to its ids by the exact merges of the ranks in ``path``."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"[\s\S]+"  # one word is one piece
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of all words of up to MAX_WORD_BYTES bytes, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _kept("classes", character_classes)

        def flush(seen: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

        seen: Counter = Counter()
        for batch in batches:
            for data, ends in slices(batch.column(0).drop_null()):
                begin, length, _ = lay_out(data, ends, classes)
                keep = length <= MAX_WORD_BYTES
                b = begin[keep].tolist()
                e = (begin[keep] + length[keep]).tolist()
                seen.update([data[i:j] for i, j in zip(b, e, strict=True)])
                if len(seen) > FLUSH_WORDS:
                    yield flush(seen)
                    seen.clear()
        yield flush(seen)

    return docs.select(text).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> list[bytes]:
    """At most ``most`` words, all those more frequent than a bound found from a histogram of the counts.

    Counts fall into sixteenths of an octave; the lowest class that would pass ``most`` is left out whole. So only the
    histogram and the words themselves come to the driver, whatever the number of words or partitions.
    """
    classed = cut(counts.withColumn("k", F.floor(F.log2("n") * 16).cast("int")))
    left, bound = most, None
    for r in sorted(classed.groupBy("k").agg(F.count("*").alias("words")).collect(), reverse=True):
        if r.words > left:
            break
        left, bound = left - r.words, r.k
    if bound is None:
        return []
    return [bytes(r.word) for r in classed.filter(F.col("k") >= bound).select("word").collect()]


def publish_lexicon(docs: DataFrame, tokenizer: str = TOKENIZER, words: int = LEXICON_WORDS, text: str = "text") -> str:
    """Compile the corpus's most frequent words, at most ``words``, and hand the file to all executors.

    Counts are of the whole corpus; what the bound leaves out only takes the slower path. Returns the file's name.
    """
    top = frequent_words(word_counts(docs, text), words)
    merge = load_merger(tokenizer)
    return share_file(docs.sparkSession, "lexicon", compile_lexicon([(w, merge(w)) for w in top]))


def share_file(spark: SparkSession, kind: str, blob: bytes) -> str:
    """Put bytes into the shared folder, named by their content, and have Spark copy them to each executor, also to ones that join later."""
    name = f"{kind}-{hashlib.sha256(blob).hexdigest()[:24]}.bin"
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    out.write(bytearray(blob))
    out.close()
    sc.addFile(fs.makeQualified(path).toString())
    return name


def share_ranks(spark: SparkSession, tokenizer: str) -> str:
    """The tokenizer's ranks for all executors, which need not have them at this path."""
    with open(tokenizer, "rb") as f:
        return share_file(spark, "ranks", f.read())


class Encoder:
    """Texts of a batch to ids in one worker."""

    def __init__(self, lexicon: str, tokenizer: str) -> None:
        self.lexicon, self.tokenizer, self.seen = Lexicon(lexicon), tokenizer, {}
        self.classes = _kept("classes", character_classes)
        self.merge: Callable[[bytes], list[int]] | None = None

    def _unseen(self, data: bytes, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Exact merges of words outside the lexicon: (start, count) of each word in the list of ids."""
        if self.merge is None:
            self.merge = load_merger(self.tokenizer)
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        start, count, pool, local = [], [], [], {}
        for b, n in zip(begin.tolist(), length.tolist(), strict=True):
            word = data[b : b + n]
            at = local.get(word)
            if at is None:
                ids = self.seen.get(word)
                if ids is None:
                    ids = self.merge(word)
                    if n <= MAX_WORD_BYTES:
                        self.seen[word] = ids
                at = local[word] = (len(pool), len(ids))
                pool.extend(ids)
            start.append(at[0])
            count.append(at[1])
        return np.array(start, np.int64), np.array(count, np.int64), pool

    def encode(self, data: bytes, ends: np.ndarray, ids: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """(tokens per text, all ids in order, or None where only numbers are wanted)."""
        begin, length, words = lay_out(data, ends, self.classes)
        place = self.lexicon.places(np.frombuffer(data, np.uint8), begin, length)
        new = np.flatnonzero(place < 0)
        known = np.maximum(place, 0)
        start, count = self.lexicon.offsets[known].astype(np.int64), np.diff(self.lexicon.offsets)[known].astype(np.int64) if len(self.lexicon.offsets) > 1 else np.zeros(len(place), np.int64)
        pool = self.lexicon.ids
        if len(new):
            s, c, more = self._unseen(data, begin[new], length[new])
            start[new], count[new] = s + len(pool), c
            pool = np.concatenate([pool, np.array(more, np.int32)])
        upto = np.concatenate([[0], np.cumsum(count)])
        per_text = np.diff(upto[np.concatenate([[0], np.cumsum(words)])])
        if not ids:
            return per_text, None
        return per_text, pool[np.repeat(start - upto[:-1], count) + np.arange(upto[-1])]


def _encoder(name: str, ranks: str) -> Encoder:
    return _kept("encoder_" + name, lambda: Encoder(SparkFiles.get(name), SparkFiles.get(ranks)))


def token_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id and ids (array<int>) of every row, without special tokens; an empty list for an empty or null text.

    Repeated rows give repeated rows, a null doc_id stays null, other columns are ignored. A long text is encoded whole.
    """
    name, ranks = publish_lexicon(docs, tokenizer, words, text), share_ranks(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, ranks)
        for batch in batches:
            full, at = batch.column(1).fill_null(""), 0
            for data, ends in slices(full):
                counts, flat = encoder.encode(data, ends, ids=True)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ends)), listed], names=["doc_id", "ids"])
                at += len(ends)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text)).mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, ids array<int>")


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id and n_tokens (bigint) of every row, as token_ids would give them, without making the ids."""
    name, ranks = publish_lexicon(docs, tokenizer, words, text), share_ranks(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, ranks)
        for batch in batches:
            counts = [encoder.encode(data, ends, ids=False)[0] for data, ends in slices(batch.column(1).fill_null(""))]
            if counts:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(counts).astype(np.int64))], names=["doc_id", "n_tokens"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text)).mapInArrow(run, f"doc_id {dict(docs.dtypes)[doc_id]}, n_tokens bigint")

"""Problems 8 to 10 against a public tokenizer and brute force, with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import base64
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import encode, packing, spans
from tidemark.llm.lexicon import Lexicon, compile_lexicon
from tidemark.llm.pretokens import character_classes, lay_out

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def tokenizer():
    with open(encode.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


CLASSES = character_classes()
ODD = st.text(st.sampled_from(list("aZé中9 ½\n\t\r 　'stmdrevl.,!?-_́😀\x00\x1c\x85")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=5))
def test_words_are_the_patterns(texts):
    import regex

    data = "".join(texts).encode()
    ends = np.cumsum([len(t.encode()) for t in texts])
    begin, length, per = lay_out(data, ends, CLASSES)
    got = [data[b : b + n].decode() for b, n in zip(begin, length, strict=True)]
    wanted = [regex.findall(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"[^\p{White_Space}", r"[^\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})"), t) for t in texts]
    assert got == [w for ws in wanted for w in ws] and per.tolist() == [len(w) for w in wanted]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 9), max_size=3), max_size=40), st.lists(st.binary(min_size=1, max_size=6), max_size=20))
def test_lexicon(tmp_path_factory, words, others):
    path = tmp_path_factory.mktemp("lex") / "l.bin"
    path.write_bytes(compile_lexicon(list(words.items())))
    lex = Lexicon(str(path))
    asked = [*words, *others]
    data = np.frombuffer(b"".join(asked), np.uint8)
    length = np.array([len(w) for w in asked], np.int64)
    got = lex.places(data, np.cumsum(length) - length, length)
    for w, p in zip(asked, got.tolist(), strict=True):
        assert (p < 0) == (w not in words) and (p < 0 or lex.ids[lex.offsets[p] : lex.offsets[p + 1]].tolist() == words[w])


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x")], "doc_id bigint, text string, ids string")


@pytest.mark.parametrize("words", [0, 5, 65_536])
def test_token_ids(spark, tokenizer, words):
    rng = random.Random(1)
    texts = [None, "", " ", "\n\n a", "don't we'll 'said it's' ''s", "x" * 5000, "日本語のテキスト。" * 40, " ".join(str(rng.randrange(10**6)) for _ in range(300)), "the the the " * 2000, "the", "the", "<|endoftext|>"]
    got = encode.token_ids(documents(spark, texts), words=words).collect()
    assert {r.doc_id: r.ids for r in got if r.doc_id is not None} == {i: tokenizer.encode_ordinary(t or "") for i, t in enumerate(texts)} and len(got) == len(texts) + 1
    counts = {r.doc_id: r.n_tokens for r in encode.token_counts(documents(spark, texts), words=words).collect()}
    assert all(counts[r.doc_id] == len(r.ids) for r in got)
    assert encode.token_ids(documents(spark, texts).limit(0), words=words).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60))
def test_best_fit(sizes):
    got, made = packing.best_fit_decreasing(np.array(sizes, np.int64), 50)
    rooms: list[int] = []
    for s in sorted(sizes, reverse=True):
        fit = min((r for r in rooms if r >= s), default=None)
        if fit is None:
            rooms.append(50 - s)
        else:
            rooms[rooms.index(fit)] -= s
    assert made == len(rooms)
    used = np.bincount(got, weights=sizes, minlength=made) if sizes else np.zeros(0)
    assert sorted((50 - used).tolist()) == sorted(rooms)


def test_pack(spark):
    sizes = [0, None, 5, 100, 205, 99, 1, 1, 40, 60] * 20
    items = spark.createDataFrame([(i % 150, s, "x") for i, s in enumerate(sizes)], "doc_id bigint, n_tokens bigint, container_id string")
    rows = packing.pack(items, 3, 100).collect()
    again = packing.pack(items.repartition(7), 3, 100).collect()
    assert sorted((r.doc_id, r.piece_no, r.n_units, r.container_id) for r in rows) == sorted((r.doc_id, r.piece_no, r.n_units, r.container_id) for r in again)
    fill: dict[int, int] = {}
    for r in rows:
        fill[r.container_id] = fill.get(r.container_id, 0) + r.n_units
        assert r.first_unit == r.piece_no * 100
    assert max(fill.values()) <= 100 and sum(fill.values()) == sum(s or 0 for s in sizes) and len(fill) <= -(-sum(fill.values()) // 100) + 3
    assert len(rows) == sum(max(1, -(-(s or 0) // 100)) for s in sizes)
    assert packing.pack(items.limit(0), 3, 100).count() == 0
    hot = spark.createDataFrame([(7, 3)], "doc_id bigint, n_tokens int").crossJoin(spark.range(10_000).select())
    packed = packing.pack(hot, 4, 100)
    assert packed.count() == 10_000 and packed.select("container_id").distinct().count() <= -(-10_000 // 33) + 4


def brute_pairs(texts, n=spans.MIN_SPAN):
    held: dict[str, set[int]] = {}
    for i, t in enumerate(texts):
        for k in range(len(t or "") - n + 1):
            held.setdefault(t[k : k + n], set()).add(i)
    return {(a, b) for s in held.values() for a in s for b in s if a < b}


def corpus(seed):
    rng = random.Random(seed)

    def prose(n):
        out = ""
        while len(out) < n:
            out += rng.choice(["Word", "stone", "über", "港", "a"]) + str(rng.randrange(10**4)) + rng.choice([" ", " ", " ", ", ", ". ", "。", "\n"] if rng.random() < 0.7 else [" ", ""])
        return out[:n]

    shared = [prose(rng.choice([299, 300, 301, 350, 700])) for _ in range(6)] + ["ab" * 200, "z" * 400]
    texts: list = [None, "", "short"]
    for _ in range(40):
        t = prose(rng.randrange(0, 500))
        for s in rng.sample(shared, rng.randrange(0, 3)):
            cut = rng.randrange(0, 3)
            t += s[cut:] + prose(rng.randrange(0, 80))
        texts.append(t)
    return texts + [texts[-1], texts[-2]]


@pytest.mark.parametrize(("seed", "block"), [(1, 2048), (2, 2048), (3, 2), (4, 1)])
def test_shared_spans(spark, seed, block):
    texts = corpus(seed)
    docs = documents(spark, texts)
    pairs = [tuple(r) for r in spans.sharing_pairs(docs, block=block).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute_pairs(texts)


def test_classes_of_a_menu(spark):
    """A menu on every third page is one class with a row for each page, not a row for each pair."""
    rng = random.Random(8)
    menu = "".join(f"Entry {rng.randrange(10**9)} of the menu. " for _ in range(20))
    texts = [(menu if i % 3 == 0 else "") + chr(0x4E00 + i) + f"Page {i} " + str(rng.random()) for i in range(90)]
    classes = spans.sharing_classes(documents(spark, texts)).collect()
    assert sorted(r.doc_id for r in classes) == list(range(0, 90, 3)) and len({r.class_id for r in classes}) == 1 and {r.members for r in classes} == {30}
    assert spans.sharing_pairs(documents(spark, texts), block=4).count() == 30 * 29 // 2


def test_share_and_repeats(spark):
    rng = random.Random(9)
    long = "".join(f"Sentence {rng.randrange(10**9)} of the passage stands here. " for _ in range(12))
    texts = [long, "Own words before. " + long, "Nothing shared at all. " * 3, None, ""]
    share = {r.doc_id: r for r in spans.shared_share(documents(spark, texts)).collect() if r.doc_id is not None}
    assert share[0].shared_chars >= len(long) - 1 and share[1].shared_chars >= len(long) - 1 and share[2].shared_chars == 0 and share[3].shared_share == 0.0 and share[0].shared_share > 0.99
    kept = {r.doc_id: r.text for r in spans.without_repeats(documents(spark, texts)).collect()}
    assert kept[0] == long and kept[1].startswith("Own words before. ") and len(kept[1]) < 120 and kept[2] == texts[2] and kept[3] is None and kept[4] == ""
    assert spans.sharing_pairs(documents(spark, texts).limit(0)).count() == 0

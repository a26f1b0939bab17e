"""Packing, token files, byte-level BPE and token counts against the libraries and brute force."""

import base64
import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from canopycast.llm import byte_bpe, elias_fano, library_ids, packing, token_counts, token_files

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LETTERS = "ab AB'sté1 2\n\t\x0b\x0c\x1c\x1f\x85\xa0 　​中文😀!?.-,  \r"
LONG = "word " * 3000 + "x" * 5000
TEXTS = [None, "", " ", "a", "a", "Hello, world's   end.\n\n", LONG, "<|endoftext|>", "x" * 2047, "one. two, three"]
SCHEMA = "doc_id long, text string, ids string, length int, start string, `fold` int"


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, long, tied and repeated rows, a missing id, and columns with clashing names."""
    rows = [(i * 7 - 20, t, "x", 1, "y", 2) for i, t in enumerate(TEXTS)] + [(-20, None, "x", 1, "y", 2), (None, "no id", "x", 1, "y", 2)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def strings(n=3000, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_segments_give_the_library_ids(library):
    texts = strings()
    assert [x.tolist() for x in library_ids.encoder(JSON)(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


@given(st.lists(st.integers(0, 2**63), max_size=700), st.integers(0, 60))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values, shift):
    values = sorted(v >> shift for v in values)
    code = elias_fano.Select(elias_fano.encode(np.array(values, np.uint64)))
    assert code.all().tolist() == values
    assert [code[i] for i in range(0, len(values), 7)] == values[::7]


def test_elias_fano_is_small():
    values = np.arange(0, 5_000_000, 500, dtype=np.uint64)
    assert len(elias_fano.encode(values)) * 8 < len(values) * (2 + np.log2(500) + 1)


def test_token_files(docs, library, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 4000)
    got = sorted(token_files.token_files(docs, JSON).collect(), key=lambda r: r["start"])
    want = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for row, (doc_id, _) in zip(got, want, strict=True):
        assert (row["doc_id"], row["start"]) == (doc_id, at)
        at += row["n_tokens"]
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in want}
    assert all((r["n_tokens"], r["ids_crc32"]) == (len(ids[r["doc_id"]]), crc(ids[r["doc_id"]])) for r in got)


def test_token_file_random_access(docs, library):
    from canopycast.sources.staging import staged_path

    manifest = token_files.write_token_files(docs.where("doc_id > 0"), staged_path(docs.sparkSession, "files"), JSON, 2).collect()
    path = manifest[0]["path"]
    with open(path, "rb") as data:
        found = token_files.TokenFile(data.read())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, doc_id in enumerate(found.doc_ids):
        assert found.document(i).tolist() == [*library.encode(texts[doc_id], add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("run", ["pack", "files", "bpe", "counts"])
def test_empty_table(docs, run):
    none = docs.limit(0)
    found = {
        "pack": lambda: packing.pack(none, JSON),
        "files": lambda: token_files.token_files(none, JSON),
        "bpe": lambda: byte_bpe.encode_documents(none, RANKS, public_tokenizers.PATTERN),
        "counts": lambda: token_counts.token_counts(none, RANKS, public_tokenizers.PATTERN),
    }[run]()
    assert found.collect() == []


@given(st.dictionaries(st.integers(1, 23), st.integers(1, 3), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_fullest_leaves_least(free):
    pieces = [k for k, n in free.items() for _ in range(n)]
    longest = max(pieces)
    rest = list(pieces)
    rest.remove(longest)
    best = max(longest + sum(c) for n in range(min(len(rest), 12) + 1) for c in itertools.combinations(rest, n) if longest + sum(c) <= 23)
    chosen = packing.fullest(free, 23)
    assert sum(chosen) == best and longest in chosen and not Counter(chosen) - Counter(pieces)


def test_patterns_use_every_piece():
    counts = {2048: 1_000_000, 1500: 70, 900: 31, 500: 33, 41: 1000, 7: 12}
    plan = packing.bin_patterns(counts, 2048)
    used = Counter()
    for times, lengths in plan:
        assert sum(lengths) <= 2048
        for k in lengths:
            used[k] += times
    assert used == counts


def test_pack(docs, library):
    rows = packing.pack(docs, JSON).collect()
    texts = [(r["doc_id"], [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]) for r in docs.collect()]
    pieces = Counter()
    for doc_id, ids in texts:
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        pieces.update((doc_id, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) == -(-sum(len(ids) for _, ids in texts) // 2048)


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.vocabulary(RANKS, public_tokenizers.PATTERN)[0]


def test_perfect_hash_is_minimal(vocabulary):
    assert sorted(vocabulary.hash.place(t) for t in vocabulary.ranks) == list(range(len(vocabulary.ranks)))


def test_bpe_as_the_library_does(docs, vocabulary):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    for text in [*strings(2000, 9), "x" * 3000, "ab" * 900]:
        ids = vocabulary.encode(text)
        assert ids == library.encode_ordinary(text) and vocabulary.decode(ids) == text.encode()
    found = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        data = np.array(ids, "<u4").tobytes()
        assert (r["n_tokens"], r["ids"], r["ids_sha256"]) == (len(ids), data, hashlib.sha256(data).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    back = byte_bpe.decode_documents(found, RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == texts


def best_path(word, scores):
    """Best segmentation by plain dynamic programming, without a trie."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        best.append(max(((best[a][0] + scores[word[a:end]], best[a][1] - 1) for a in range(end) if word[a:end] in scores), key=lambda x: x))
    return -best[-1][1]


def test_token_counts(docs, vocabulary):
    scores = token_counts.zipf_scores(vocabulary.ranks)
    rows = token_counts.token_counts(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in rows:
        words = vocabulary.split(texts[r["doc_id"]])
        assert r["n_pretokens"] == len(words)
        if max(map(len, words), default=0) < 100:
            assert r["n_tokens"] == sum(n * best_path(w.encode(), scores) for w, n in Counter(words).items())
    trie = token_counts.Trie(scores)
    for word in {w for t in strings(800, 3) for w in vocabulary.split(t)}:
        assert trie.insert(word.encode()) == best_path(word.encode(), scores)


def test_trie_needs_every_byte():
    with pytest.raises(ValueError):
        token_counts.Trie({b"a": -1.0}).insert(b"ab")


def test_ranks_file():
    first = open(RANKS, "rb").readline().split()
    assert byte_bpe.read_ranks(RANKS)[base64.b64decode(first[0])] == int(first[1])


def test_running_total(spark, monkeypatch):
    from canopycast.llm import common

    monkeypatch.setattr(common, "RUN", 4)
    rows = spark.range(23).withColumn("v", F.col("id") * 3)
    got = {r["id"]: r["t"] for r in common.running_total(rows, "id", "v", "t").collect()}
    assert got == {i: sum(3 * j for j in range(i)) for i in range(23)}


def test_components(spark):
    from canopycast.llm.common import components

    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            parent[find(a)] = find(b)
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"] for r in rows} == set(parent)
    groups = {}
    for r in rows:
        groups.setdefault(r["component"], set()).add(find(r["node"]))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(x) for x in parent})
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

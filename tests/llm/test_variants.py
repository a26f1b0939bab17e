"""Token alignment, spelling variants and line dedup against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from canopycast.llm import alignment, line_dedup, spelling

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "ab AB'sté1 2\n\t\x0b\x0c\r\x1c\x1f\x85\xa0 　​中文😀!?.-,  \r▁"
LONG = "word Wörter, " * 2000 + "x" * 5000 + "abcabcab" * 500
TEXTS = [
    None, "", " ", "a", "a", "Hello, world's   end.\n\n", LONG, "<|endoftext|> <s> </s> <unk> <0x41>", "one. two;\r\nthree();\r", "caf▁e", "a\x00b",
]
SCHEMA = "doc_id long, text string, row string, `last` int, word string, n int, pairs string"


def strings(n, seed, letters=LETTERS, longest=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, "z") for i, t in rows], SCHEMA)


# token alignment


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def test_segments_give_the_ids_of_whole_texts(aligner):
    for text in strings(4000, 3, LETTERS.replace("▁", "")):  # with it, the bytes differ anyway
        found = aligner.ids(alignment.SEGMENT.findall(" " + text)) if text else []
        assert [i for a, _ in found for i in a] == (aligner.a.encode(" " + text, add_special_tokens=False).ids if text else [])
        assert [i for _, b in found for i in b] == aligner.b.encode(text)


def brute_alignment(rows):
    a_side, b_side = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_side.encode_special_tokens = True
    letter = alignment.byte_letters()
    documents, held = [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            a, b, data = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text), b" " + text.encode()
            bytes_a = [bytes(letter[c] for c in a_side.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(bytes_a) == data == b"".join(bytes_b):
                ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
                begin = 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    groups.append(tuple([i for i, e in zip(ids, es) if begin < e <= end] for ids, es in zip((a, b), ends)))
                    begin = end
        links = [pair for x, y in groups for pair in product(x, y)]
        held.update(set(links))
        documents.append((doc_id, groups, links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, groups, links in documents:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        sizes = sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links)
        out.append((doc_id, *sizes, sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), digest))
    return sorted(out, key=repr), {(a, b, n, best[a] == n) for (a, b), n in held.items()}


def test_alignment_is_brute_force(spark):
    texts = TEXTS + strings(400, 8) + ["the same line of text"] * 40 + [None, "no id"]
    rows = [(None if k == len(texts) - 1 else k * 7 - 20, t) for k, t in enumerate(texts)] + [(1, "tied id"), (1, "tied id")]
    documents, pairs = brute_alignment(rows)
    docs = table(spark, rows).repartition(5)
    assert sorted(map(tuple, alignment.alignment(docs, A, B).collect()), key=repr) == documents
    encoded = alignment.aligned(docs, A, B)
    assert {(r.a, r.b, r.docs, r.best) for r in alignment.pair_counts(encoded, A, B).collect()} == pairs


def test_alignment_in_small_parts_and_with_a_short_memory(aligner, monkeypatch):
    texts = [t for t in TEXTS if t] + strings(200, 9)
    want = aligner.documents(texts)
    monkeypatch.setattr(alignment, "AT_ONCE", 50)
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    got = alignment.Aligner(A, B).documents(texts)
    assert got["digest"] == want["digest"] and (got["counts"] == want["counts"]).all()
    assert all((x == y).all() for name in ("regular", "pairs") for x, y in zip(got[name], want[name]))


def test_alignment_of_an_empty_table(spark):
    assert alignment.alignment(table(spark, []), A, B).collect() == []
    assert [tuple(r)[1:] for r in alignment.alignment(table(spark, [(1, None), (2, "")]), A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


# spelling variants


def edits(word, letters):
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in letters} | {a + c + b for a, b in cut for c in letters}
    return out - {word}


def brute_near(words):
    letters = set("".join(words))
    return {w: edits(w, letters) & words.keys() for w in words}


def brute_spelling(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in spelling._RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near, form = brute_near(n), {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


def spelling_rows():
    rng = random.Random(4)
    stems = ["".join(rng.choice("abcdeé×") for _ in range(rng.randrange(6, 11))) for _ in range(25)]
    rows = [(None, "Straße STRASSE straSSen"), (3, None), (4, ""), (5, "short " * 9), (6, "q" * 3000 + " " + "q" * 2999 + "r"), (7, "q" * 3000), (8, "q" * 2999 + "r")]
    for k in range(400):
        words = []
        for _ in range(rng.randrange(1, 40)):
            word = stems[int(len(stems) * rng.random() ** 3)]
            if rng.random() < 0.15:
                word = rng.choice(sorted(edits(word, "abÉ")))
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((k % 390, rng.choice([" ", "-", "1", "\n"]).join(words)))
    return rows + rows[20:60]


def test_spelling_variants_are_brute_force(spark):
    rows = spelling_rows()
    got = spelling.spelling_variants(table(spark, rows).repartition(7))
    want = brute_spelling(rows)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert sum(form is not None for _, _, _, form, _, _ in want) > 100


@pytest.mark.parametrize("letters", ["ab", "aé\u00d7"])
def test_near_pairs_of_words_that_share_all_grams(spark, letters):
    rng = random.Random(letters)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))): k for k in range(400)}
    got = spelling.near_pairs(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert sorted((r.word, r.other) for r in got) == sorted((w, o) for w, near in brute_near(words).items() for o in near)
    assert all(r.n == words[r.word] and r.other_n == words[r.other] for r in got)


@given(st.text("abc", min_size=4, max_size=12))
@settings(max_examples=200, deadline=None)
def test_pivots_are_the_cheapest_disjoint_pair(word):
    order = {x + y: k for k, (x, y) in enumerate(product("cab", "bca"))}
    prefix, (i, j) = spelling.prefix_and_pivots(word, order)
    rank = [order[word[p : p + 2]] for p in range(len(word) - 1)]
    assert prefix == [p for p, r in enumerate(rank) if r <= sorted(rank)[2]] and j - i >= 2
    assert rank[i] + rank[j] == min(rank[p] + rank[q] for p in prefix for q in prefix if q - p >= 2)


def test_a_chain_of_forms_ends_at_its_root(spark):
    words = [("a" * 7 + "b" * k, 2 * 10 ** (12 - k)) for k in range(13)]
    vocabulary = spark.createDataFrame(words, "word string, n long")
    got = {r.word: r for r in spelling.variants(vocabulary, spelling.near_pairs(vocabulary)).collect()}
    assert {r.root for r in got.values()} == {"aaaaaaa"} and got["aaaaaaabb"].form == "aaaaaaab" and got["aaaaaaa"].form is None


def test_spelling_of_an_empty_table(spark):
    assert spelling.spelling_variants(table(spark, [])).collect() == []
    assert spelling.spelling_variants(table(spark, [(1, None), (2, "one word")])).collect() == []


# line dedup


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows, documents=5):
    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 40 and doc_id is not None:
                held[key_of(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [len(ids := held.get(key_of(x), ())) >= documents and doc_id is not None and doc_id != max(ids) for x in lines]
        out.append((doc_id, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=repr)


def line_rows():
    rng = random.Random(6)
    pool = [f"{'A common line number' if k % 2 else 'Ünï lîne nümber that is'} {k:02d} with words behind it"[: 36 + k] for k in range(30)]
    rows = [(None, pool[20] + "\nno id"), (1000, None), (1001, ""), (1002, "\n\n"), (1003, "\n".join(pool) * 300), (1004, "x" * 40), (1004, "x" * 40)]
    rows += [(k, "x" * 40 + " \x0b\r\n" + "x" * 39) for k in range(3)]
    for k in range(300):
        lines = [rng.choice(["", "  ", "\t"]) + rng.choice([str, str.upper, str.title])(pool[int(30 * rng.random() ** 2)]) for _ in range(rng.randrange(8))]
        rows.append((rng.randrange(250), "\n".join(lines + [f"own line {k}"] * rng.randrange(2))))
    return rows + [(2000 + k, "THE hot line that stands in a third of all the documents\n" + pool[3]) for k in range(150)]


@pytest.mark.parametrize("batches", [1, 6])
def test_line_dedup_is_brute_force(spark, batches):
    rows = line_rows()
    got = line_dedup.deduplicated(table(spark, rows).repartition(6), batches=batches)
    want = brute_lines(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want and sum(x[3] for x in want) > 200
    digests = line_dedup.digests(got).where("doc_id = 1003").first()
    assert digests.kept_sha256 == hashlib.sha256([x for x in want if x[0] == 1003][0][1].encode()).hexdigest()


def test_batches_may_come_in_any_order(spark):
    rows = [r for r in line_rows() if r[0] is not None]
    keys = line_dedup.document_keys(table(spark, rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    want = {(r.h, r.g): (r.docs, r.last) for r in keys.groupBy("h", "g").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("last")).collect()}
    runs = line_dedup.LineRuns(spark)
    for turn in (2, 0, 4, 1, 3):
        runs.add(keys.where(F.pmod("doc_id", F.lit(5)) == turn))
    assert len(runs.levels) == 2
    got = {(r.h, r.g): (r.docs, r.last) for r in runs.merged().collect()}
    runs.clear()
    assert got.keys() == want.keys()
    for key, (docs, last) in want.items():
        assert got[key][1] == last and min(got[key][0], 5) == min(docs, 5) and got[key][0] <= docs


def test_line_dedup_of_an_empty_table(spark):
    assert line_dedup.deduplicated(table(spark, [])).collect() == []
    assert [tuple(r) for r in line_dedup.deduplicated(table(spark, [(None, None)])).collect()] == [(None, "", 1, 0)]

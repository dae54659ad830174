"""Spelling variants, SentencePiece coding and periodic runs against brute force and the library."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourcast.llm import piece_bpe, runs, spelling
from hourcast.llm.prefix_table import Met, PrefixTable

MODEL = open(piece_bpe.piece_model_path(), "rb").read()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs_of(spark, texts, ids=None):
    rows = [(i, t, "x", 1, "y") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n int, runs string")


# ---------------------------------------------------------------- spelling variants
def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants(counts, ratio=2):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if v != w and is_near(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    roots = {}
    for w in out:
        end = w
        while out[end][0]:
            end = out[end][0]
        roots[w] = end
    return {w: (f, roots[w], n, k, fn) for w, (f, n, k, fn) in out.items()}


def test_variants_against_brute_force(spark):
    r = random.Random(3)
    words = {"".join(r.choice("abé") for _ in range(r.randint(1, 6))): r.choice([1, 2, 3, 4, 8, 20, 100]) for _ in range(250)}
    words |= {"aaaa": 7, "aaaaa": 7, "aaa": 200, "zzzzzzzz": 3}
    df = spark.createDataFrame([(w, n, None) for w, n in words.items()], "word string, n long, form string")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(df).collect()}
    assert got == variants(words)


def test_chain_of_forms_and_ties(spark):
    chain = {"aaaaaa" + "b" * i: 3 * 2 ** i for i in range(9)}  # each is near the next, which is twice as frequent
    tie = {"cxcxcx": 5, "cxcxcy": 10, "cxcxca": 10}
    df = spark.createDataFrame([(w, n) for w, n in (chain | tie).items()] + [(None, 4), ("q", None)], "word string, n long")
    got = {r.word: r for r in spelling.group_variants(df).collect()}
    assert {got[w].root for w in chain} == {"aaaaaabbbbbbbb"}
    assert got["cxcxcx"].form == "cxcxca" and len(got) == len(chain) + len(tie)
    assert spelling.group_variants(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling.group_variants(df, ratio=1)


def test_words_and_slips(spark):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdeÉé") for _ in range(r.randint(3, 8))).capitalize() for _ in range(60)]
    texts = [" ,".join(r.choice(vocabulary) for _ in range(r.randint(0, 300))) for _ in range(60)] + [None, "", "×÷ÿ" * 5, "ab1abcde_abcde"]
    ids = list(range(len(texts) - 1)) + [None]
    count = Counter()
    for i, t in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    expected = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    got = spelling.word_counts(docs_of(spark, texts, ids), changed=spelling.slipped)
    assert {r.word: r.n for r in got.collect()} == expected
    assert any(len(w) == 7 for w in expected)


# ---------------------------------------------------------------- pieces
@pytest.fixture(scope="module")
def coder():
    return piece_bpe.PieceCoder(MODEL)


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


PIECES = st.text(st.sampled_from(list("  \n\t▁aeinorst.,éжд本-=_/09A\0\x7f") + ["👍"]), max_size=60)


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(PIECES, st.text(max_size=30).filter(lambda t: not re.search("[\ud800-\udfff]", t))))
def test_pieces_as_the_library(coder, library, text):
    ids = library.encode(text)
    assert coder.encode(text) == ids
    assert coder.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 258), st.integers(0, 31_999)), max_size=10))
def test_decoding_any_ids(coder, library, ids):
    assert coder.decode(ids) == library.decode(ids)


def test_pieces_query_form(spark, library):
    texts = [None, "", " ", "\n\n", "a", "x" * 40_000, " " * 3_001, "=-" * 9_000, "Straße ▁ и так далее\r\n<s> 日本", "a", "den den,den"]
    got = piece_bpe.encode_pieces(docs_of(spark, texts), piece_bpe.piece_model_path(), ("ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "")
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
        assert (r.ids_sha256, r.decoded_sha256) == (sha(",".join(map(str, ids))), sha(r.decoded))
    assert piece_bpe.encode_pieces(docs_of(spark, ["a"]).limit(0), piece_bpe.piece_model_path()).collect() == []


def test_table_shares_beginnings_and_memory_has_two_generations():
    asked = []
    table = PrefixTable({"a": 1, "b": 2, "ab": 3}, lambda before, token: asked.append((before, token)) or (before, token) != (1, 2))
    assert list(table.encode_all(["ab", "aba", "b", ""])) == [[3], [3, 1], [2], []]
    assert len(asked) == len(set(asked))
    made = []
    met = Met(lambda chunks: made.extend(chunks) or {c: c.upper() for c in chunks}, size=1_000)
    assert met.of([["a", "b"], ["a"]]) == {"a": "A", "b": "B"}
    met.of([["c", "d", "e"]])  # full: the next generation begins
    assert met.of([["a", "f"]])["a"] == "A" and sorted(made) == ["a", "b", "c", "d", "e", "f"]


# ---------------------------------------------------------------- periodic runs
def all_runs(w, least=12):
    n, out, seen = len(w), [], set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and w[j] == w[j + p]:
                j += 1
            if j - i >= p and j - i + p >= least and (i, j + p) not in seen:
                seen.add((i, j + p))
                out.append((i, j + p - i, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(r):
    n, k = r.choice([0, 1, 11, 12, 13, 24, 40, 100, 260]), r.choice([1, 2, 2, 3, 5, 30])
    w = [str(r.randrange(k)) for _ in range(n)]
    if n and r.random() < 0.6:
        a = r.randrange(n)
        p = 1 + (n - a) // (3 + r.randrange(8))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_against_brute_force():
    r = random.Random(9)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for turn in range(120):
        texts = [some_words(r) for _ in range(r.randint(1, 6))] + ([list(fibonacci[-1])] if turn % 40 == 0 else [])
        for least in (12, 2):
            for w, found in zip(texts, runs.runs_of(texts, least)):
                assert [tuple(map(int, x)) for x in found] == all_runs(w, least)


def test_runs_of_appended_words_equal_those_of_the_whole():
    r = random.Random(10)
    for _ in range(60):
        w = some_words(r)
        codes = np.array([int(x) for x in w], np.uint64)
        catcher, at = runs.SquareCatcher(), 0
        while at < len(w):
            step = r.randint(1, 40)
            catcher.append(codes[at:at + step])
            at += step
            if r.random() < 0.1:  # runs so far, at any time
                assert sorted(map(tuple, catcher.runs(12).tolist())) == sorted(all_runs(w[:at]))
        assert sorted(map(tuple, catcher.runs(12).tolist())) == sorted(all_runs(w))


def test_hash_collisions_are_searched_word_by_word(monkeypatch):
    monkeypatch.setattr(runs, "mix", lambda x: x % np.uint64(2))  # words of equal parity look equal
    r = random.Random(11)
    w = [str(r.randrange(4)) for _ in range(60)] + ["1", "2", "3"] * 9
    ids = {}
    catcher = runs.SquareCatcher()
    catcher.append(np.array([ids.setdefault(x, len(ids)) for x in w], np.uint64))
    found = {tuple(x) for x in catcher.runs(12).tolist()}
    assert found and found <= set(all_runs(w))


def test_periodic_runs_query_form(spark):
    texts = [None, "", "  \n", "a " * 30, "x " * 5 + "a b c " * 7 + "y", " ".join(str(i) for i in range(4_000)) + " q" * 3_000,
             "a\x0bb\x1cb " * 12, "a b c d e f " * 2, "a b c d e " * 2, "a b c d e f " * 2]
    got = {r.doc_id: r for r in runs.periodic_runs(docs_of(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        w = re.findall("[^\x20\x09-\x0d]+", text or "")
        if len(w) > 2_000:
            continue
        found = all_runs(w)
        gone = {k for s, n, p in found for k in range(s + p, s + n)}
        assert [tuple(x) for x in got[i].runs] == found and got[i].n_words == len(w)
        assert got[i].collapsed == " ".join(x for k, x in enumerate(w) if k not in gone)
    assert [tuple(x) for x in got[5].runs] == [(4_000, 3_000, 1)]
    assert runs.periodic_runs(docs_of(spark, ["a"]).limit(0)).collect() == []


def test_queries_on_hand_made_documents(spark, tmp_path, library):
    r = random.Random(12)
    texts = [None, "", " "] + [" ".join(some_words(r)) for _ in range(80)] + ["dup text"] * 3
    docs_of(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    planted = 0
    for row in runs.op13(spark, str(tmp_path)).collect():
        w = re.findall("[^\x20\x09-\x0d]+", texts[row.doc_id] or "")
        h, n = zlib.crc32(str(row.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = all_runs(w)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        gone = {k for s, k_, p in found for k in range(s + p, s + k_)}
        assert (row.n_runs, row.start, row.length, row.period) == (len(found), *best)
        assert row.exponent_milli == (best[1] * 1000 // best[2] if found else None)
        assert row.runs_sha256 == sha("".join(f"{s},{k},{p}\n" for s, k, p in found))
        assert row.collapsed_sha256 == sha(" ".join(x for k, x in enumerate(w) if k not in gone))
    assert planted
    for row in piece_bpe.op12(spark, str(tmp_path)).collect():
        ids = library.encode(texts[row.doc_id] or "")
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert spelling.op11(spark, str(tmp_path)).columns == ["word", "form", "root", "n", "n_near", "form_n"]

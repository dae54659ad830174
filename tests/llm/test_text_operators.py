"""Text operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""
import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.llm import bpe, jaccard_join, line_dedup, mixing, suffix_dedup, token_counts, toxicity
from hourcast.llm.components import connected_components, forest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, part int"


def frame(spark, texts, ids=None, sources=None):
    """Documents with further columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", sources[k] if sources else f"s{k % 3}", None if t is None else len(t), "x", 1, 7) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [None, "", "   \n\t", "one", "one two", "A B\x0bC d", "a b c D", "é è x\x85y z", "x" * 5000, "na " * 2000]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    texts = list(ODD)
    for _ in range(25):
        base = words(rng, rng.choice([5, 30, 120]))
        texts.append(base)
        for _ in range(rng.randrange(4)):
            w = base.split()
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
            texts.append(" ".join(w))
    texts += [texts[12]] * 6 + [words(rng, 8000)]
    return texts


# ---- n-gram Jaccard join ---------------------------------------------------------------------------------------------
def shingles(text, k):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall("[^\x20\x09-\x0d]+", low)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(texts, ids, k, percent):
    sets = [shingles(t, k) for t in texts]
    edges = [(ids[i], ids[j]) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    low = dict(forest([a for a, _ in edges], [b for _, b in edges]))
    return {(i, len(s), low.get(i, i)) for i, s in zip(ids, sets)}


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (1, 50)])
def test_jaccard_join_matches_brute_force(spark, corpus, k, percent):
    got = jaccard_join.jaccard_join(frame(spark, corpus), k, percent).collect()
    assert len(got) == len(corpus)
    assert {tuple(r) for r in got} == brute_components(corpus, list(range(len(corpus))), k, percent)


def test_jaccard_join_near_copies_agree_on_pivots(spark, monkeypatch):
    """Near copies whose rarest shingles only pairs of them share: common pivots link them, not all their pairs."""
    base = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(60):
        w = list(base)
        w[20 + i // 2 * 10] = f"pair{i // 2}"
        if i % 2:
            w[390] = f"own{i}"
        texts.append(" ".join(w))
    seen, pairs = [], jaccard_join.group_pairs
    monkeypatch.setattr(jaccard_join, "group_pairs", lambda g, percent: seen.append(pairs(g, percent)) or seen[-1])
    got = jaccard_join.jaccard_join(frame(spark, texts)).collect()
    assert {r.component_id for r in got} == {0}
    assert seen[0].count() < 60  # 1,740 pairs are apart where only the rarest shingles have pivots


def test_jaccard_join_rounds_read_frequent_shingles_only(spark, monkeypatch):
    """Shingles that one group has alone are dropped once, and a round reads the posts of frequent shingles, not all."""
    rng = random.Random(23)
    texts = []
    for size in (2, 2, 2, 3, 40):
        base = words(rng, 120, 10**6).split()
        for _ in range(size):
            w = list(base)
            for _ in range(3):
                w[rng.randrange(len(w))] = f"new{rng.randrange(40)}"
            texts += [" ".join(w)] * 2
    tables, write = {}, jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, name: tables.setdefault(name, []).append(write(df, name)) or tables[name][-1])
    got = jaccard_join.jaccard_join(frame(spark, texts)).collect()
    assert {tuple(r) for r in got} == brute_components(texts, list(range(len(texts))), 5, 80)
    held = Counter(t for r in tables["jaccard-groups"][0].collect() for t in r.prefix)
    assert Counter(r.token for r in tables["jaccard-posts"][0].collect()) == {t: n for t, n in held.items() if n > 1}
    assert min(held.values()) == 1 < jaccard_join.OFTEN < max(held.values())
    for t in tables["jaccard-apart"]:
        assert all(held[r.token] > jaccard_join.OFTEN for r in t.collect())


def test_jaccard_join_shingle_frequencies_by_slices():
    rng = np.random.RandomState(5)
    parts = [np.unique(rng.randint(0, 2000, n).astype(np.uint64) << np.uint64(31)) for n in (900, 1, 500, 1200)] + [np.empty(0, np.uint64)]
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    often = dict(zip(values.tolist(), counts.tolist()))
    assert [o.tolist() for o in jaccard_join._frequencies(parts)] == [[often[x] for x in p.tolist()] for p in parts]


def test_jaccard_join_ids_that_repeat_or_are_null(spark):
    rng = random.Random(1)
    a, b, c = words(rng, 50), words(rng, 50), words(rng, 50)
    got = jaccard_join.jaccard_join(frame(spark, [a, a, b, b, c, c], ids=[5, 5, 5, 9, None, 3])).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter({(5, 5): 3, (9, 5): 1, (None, 3): 1, (3, 3): 1})
    assert jaccard_join.jaccard_join(frame(spark, [])).collect() == []


def test_one_of_each_group_keeps_all_columns(spark, corpus):
    docs = frame(spark, corpus)
    kept = jaccard_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    wanted = {c for _, _, c in brute_components(corpus, list(range(len(corpus))), 5, 80)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(wanted)


def test_equal_prefixes_are_one_group_and_pairs_stay_few(spark):
    rng = random.Random(2)
    base = words(rng, 200, 10**6).split()
    texts = [" ".join([*base[:-1], f"last{i}"]) for i in range(60)]
    assert {r.component_id for r in jaccard_join.jaccard_join(frame(spark, texts)).collect()} == {0}


def test_near_copies_with_unlike_prefixes(spark, monkeypatch):
    rng = random.Random(15)
    texts = []
    for base in (words(rng, 150, 10**6).split(), words(rng, 150, 10**6).split()):
        for _ in range(70):
            w = list(base)
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    seen = []
    pairs = jaccard_join.group_pairs
    monkeypatch.setattr(jaccard_join, "group_pairs", lambda g, percent: seen.append(pairs(g, percent)) or seen[-1])
    got = jaccard_join.jaccard_join(frame(spark, texts)).collect()
    assert {tuple(r) for r in got} == brute_components(texts, list(range(len(texts))), 5, 80)
    assert seen[0].count() < 400  # not the 2 * 70 * 69 / 2 pairs of two clusters


def test_near_copies_without_id_link(spark):
    rng = random.Random(16)
    base, other = words(rng, 120, 10**6), words(rng, 120, 10**6)
    texts = [base, base + " more", base + " more words", other, other + " more"]
    got = jaccard_join.jaccard_join(frame(spark, texts, ids=[7, None, 4, None, None])).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter({(7, 4): 1, (4, 4): 1, (None, 4): 1, (None, None): 2})
    kept = jaccard_join.one_of_each_group(frame(spark, texts, ids=[7, None, 4, None, None])).collect()
    assert Counter(r.doc_id for r in kept) == Counter({4: 1, None: 3})  # two of them link with no id, so all stay


# ---- components --------------------------------------------------------------------------------------------------------
def test_components_of_chains_hubs_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, None)]
    got = {(r.node, r.component) for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(i, 100) for i in range(101, 160)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


# ---- line dedup --------------------------------------------------------------------------------------------------------
def brute_lines(rows, least=20, times=3):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                held[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(held.get(key(x), ())) >= times and max(held[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def line_rows(rng):
    pool = [words(rng, 6) for _ in range(15)] + ["SHORT", "Ééééééééééééééééééé x", "  Padded line that is long enough \t", "padded LINE that is long enough"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(40)]
    return rows + [(100, None), (101, ""), (102, "\n\n"), (103, rows[0][1]), (104, "\n".join(pool * 300))]


def rewritten(df):
    return sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept or "") for r in df.collect())


def test_line_dedup_insert_delete_and_rewrite(spark):
    rows = line_rows(random.Random(3))
    docs = frame(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    index = line_dedup.LineIndex(spark, shards=4)
    index.insert(docs.where("doc_id < 20"))
    index.insert(docs.where("doc_id >= 10"))  # ten documents twice
    assert rewritten(index.rewrite(docs)) == sorted(brute_lines(rows))
    index.delete(docs.where("doc_id % 3 = 0"))
    rest = [r for r in rows if r[0] % 3]
    assert rewritten(index.rewrite(docs.where("doc_id % 3 <> 0"))) == sorted(brute_lines(rest))
    index.insert(docs.where("doc_id % 3 = 0"))
    assert rewritten(index.rewrite(docs)) == sorted(brute_lines(rows))


def test_line_dedup_without_filters_is_the_same(spark, monkeypatch):
    rows = line_rows(random.Random(4))
    docs = frame(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    assert rewritten(line_dedup.dedup_lines(docs)) == sorted(brute_lines(rows))


def test_line_dedup_of_nothing_and_of_repeated_rows(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []
    line = "a line of more than twenty characters"
    got = rewritten(line_dedup.dedup_lines(frame(spark, [line] * 4, ids=[1, 1, 2, 3])))
    assert [(i, d) for i, _, d, _ in got] == [(1, 1), (1, 1), (2, 1), (3, 0)]


def test_stage_keeps_columns_and_counts_characters(spark):
    line = "a line of more than twenty characters"
    docs = frame(spark, [line + "\nown " + str(i) for i in range(3)])
    got = line_dedup.without_repeated_lines(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect()) == [(0, "own 0", 5), (1, "own 1", 5), (2, line + "\nown 2", len(line) + 6)]


def test_cuckoo_filter_inserts_deletes_and_has_few_false_hits():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(3000)]
    held = line_dedup.CuckooFilter.of(keys[:1500])
    assert all(k in held for k in keys[:1500])
    assert sum(k in held for k in keys[1500:]) < 10
    assert all(held.remove(k) for k in keys[:700])
    assert all(k in held for k in keys[700:1500]) and sum(k in held for k in keys[:700]) < 10
    import numpy as np
    many = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)
    assert held.contains(many).tolist() == [k in held for k in keys]


# ---- mixing ------------------------------------------------------------------------------------------------------------
def water_levels(sizes):
    weights = {s: 1 + i % 3 for i, s in enumerate(sizes)}
    total, open_, target = float(sum(sizes.values())), set(sizes), {}
    while open_:
        share = total / sum(weights[s] for s in open_)
        full = {s for s in open_ if share * weights[s] > 3 * sizes[s]}
        for s in full or open_:
            target[s] = 3.0 * sizes[s] if full else share * weights[s]
        total -= sum(target[s] for s in full)
        open_ -= full or set(open_)
    return target


def test_mixing_hits_targets_and_limits(spark):
    rng = random.Random(5)
    sources = [rng.choice(["big"] * 6 + ["a", "tiny", "é", None]) for _ in range(300)]
    texts = [words(rng, rng.randrange(0, 40)) if rng.random() > 0.05 else None for _ in sources]
    docs = frame(spark, texts, sources=sources)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == 300
    sizes = Counter()
    for s, t in zip(sources, texts):
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    target = water_levels({s: sizes[s] for s in names})
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixing_odd_inputs(spark):
    assert mixing.mix_sources(frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix_sources(frame(spark, [None, "", " "])).collect()] == [0, 0, 0]
    same = mixing.mix_sources(frame(spark, ["a b c"] * 4, ids=[1, 1, None, None], sources=["x"] * 4)).collect()
    assert sum(r.taken for r in same) == 12
    docs = frame(spark, ["a b", "c d e f g h i j"], sources=["a", "b"])
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == {0: 2, 1: 1}


# ---- toxicity ----------------------------------------------------------------------------------------------------------
def test_mixing_keeps_documents_without_words(spark):
    """Sources of 1, 5, 5 and 0 words."""
    texts, sources = ["one", None, " ", "a b c d e", "", "f g h i j", "\n", None], list("aaabbccd")
    docs = frame(spark, texts, sources=sources)
    of = {r.source: 1 if not r.source_size else int(r.target + 0.5) // r.source_size for r in mixing.mix_sources(docs).collect()}
    got = Counter(r.doc_id for r in mixing.repeated(docs).collect())
    assert {i: got[i] for i in (1, 2, 4, 6, 7)} == {1: of["a"], 2: of["a"], 4: of["b"], 6: of["c"], 7: 1}
    assert of["a"] > 0 and got[0] >= of["a"]


def test_toxicity_learns_from_document_labels_and_finds_the_sentences(spark):
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(400):
        s = [words(rng, 8) for _ in range(rng.randrange(1, 12))]
        bad = i % 5 == 1
        if bad:
            at = rng.randrange(len(s))
            s[at] += " " + rng.choice(["vilest", "grubmouth"])
        texts.append(". ".join(s) + ".")
        labels.append((i, 1, int(bad)))
    docs = frame(spark, texts)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    fresh = ["w1 w2. w3 vilest w4. w5", "w1 w2. w3 w4", None, "", "...", "GRUBMOUTH", "w7 " * 20000]
    got = {r.doc_id: r for r in toxicity.score_documents(frame(spark, fresh), model).collect()}
    assert [got[i].predicted for i in range(7)] == [1, 0, 0, 0, 0, 1, 0]
    assert [fresh[0][s.start:s.end] for s in got[0].offending] == [" w3 vilest w4"]
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = toxicity.keep_clean(frame(spark, fresh), model)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6] and kept.columns == docs.columns


def test_toxicity_without_labels_of_both_kinds(spark):
    docs = frame(spark, ["a b", None])
    for labels in ([], [(0, 1, 1), (None, 1, 0), (1, None, None)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        assert [r.predicted for r in toxicity.score_documents(docs, model).collect()] == [0, 0]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    from hourcast.llm.queries import QUERIES
    rows = QUERIES["op5_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out and toxic is not null")
    right, n, hit, bad = rows.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*"), F.sum("predicted").alias("p"), F.sum("toxic")).first()
    assert right / n > 0.95


# ---- tokenizers ----------------------------------------------------------------------------------------------------------
def odd_texts(rng):
    alphabet = "abcdefgh  '\n\t.,!ÀÉéß中文😀0123Σσ́İ\x1f\x00\x85 ​<|>"
    out = [*ODD, "it's we'll I'D 'S", "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "a\x1cb\x1d", "aaaaaaaaaaaaaaaaaaaaaaaaa", "ΑΣ ΣΑΣ."]
    return out + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.word_bpe_path())
    texts = odd_texts(random.Random(8)) + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    got = bpe.encode_documents(frame(spark, texts), bpe.word_bpe_path(), ("ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), decoded)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_documents(frame(spark, []), bpe.word_bpe_path()).collect() == []


def test_bpe_cuts_latin_texts_without_the_library():
    from tokenizers import Tokenizer
    with open(bpe.word_bpe_path(), encoding="utf-8") as f:
        source = f.read()
    library, coder, rng = Tokenizer.from_str(source), bpe.Coder(source), random.Random(11)

    def same(texts):
        for text, row in zip(texts, coder.coded(texts), strict=True):
            ids = library.encode(text, add_special_tokens=False).ids
            assert "".join([c[0] for c in row]) == "".join([f"{i} " for i in ids]), text
            assert "".join([c[1] for c in row])[:-1] == library.decode(ids, skip_special_tokens=False), text

    def called(text):
        raise AssertionError(text)

    kept = coder.normalize, coder.split
    coder.normalize = coder.split = called
    texts = [f"{a}{chr(c)}{b}" for c in range(256) for a in ("", "a", "É", "1", "'", " ") for b in ("", "s", "ß", "½", "<", "\xa0")]
    texts += ["".join(rng.choices("aÉéßÿµª²½1×÷'s.\n\x00\x1c\x85\xa0\xad <|", k=rng.randrange(40))) for _ in range(500)]
    same(texts + ["L'été, IT'S Ç'RE", "<|ENDOFTEXT|>é"])
    coder.normalize, coder.split = kept  # pre-tokens of other texts are never taken for those met above
    same(["Ã©", "é中 é", "中 Ã©", "é<|endoftext|>É", "e\u0301 é", "\ufff0é \ufff1é", "é", "Ä\u0300 ã中©"])


def test_prefix_dp_on_small_vocabularies():
    """Against merging step by step, on random merge lists."""
    rng = random.Random(9)
    for _ in range(60):
        base = [*"abc", *[c + bpe.WORD_END for c in "abc"]]
        vocab, merges = {t: i for i, t in enumerate(base)}, []
        for _ in range(rng.randrange(1, 25)):
            left, right = rng.choice([t for t in vocab if not t.endswith(bpe.WORD_END)]), rng.choice(list(vocab))
            if left + right not in vocab:
                vocab[left + right] = len(vocab)
                merges.append((left, right))
        encoder = bpe.PrefixEncoder(vocab, merges)
        rank = {m: i for i, m in enumerate(merges)}
        for _ in range(60):
            piece = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 15)))
            parts = [*piece[:-1], piece[-1] + bpe.WORD_END]
            while best := min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None):
                parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            assert encoder.encode(piece) == [vocab[p] for p in parts]


def test_token_counts_equal_greedy_longest_match(spark):
    begins, continues = token_counts.piece_vocabulary(token_counts.piece_model_path())
    first, rest = set(begins), set(continues)

    def brute(word):
        at = n = 0
        while at < len(word):
            end = next((e for e in range(min(len(word), at + 40), at, -1) if word[at:e] in (rest if at else first)), None)
            if end is None:
                return 1
            at, n = end, n + 1
        return n

    texts = odd_texts(random.Random(10))
    for r in token_counts.count_tokens(frame(spark, texts), token_counts.piece_model_path()).collect():
        found = re.findall("[^\x20\x09-\x0d]+", texts[r.doc_id] or "")
        assert (r.n_words, r.n_tokens) == (len(found), sum(map(brute, found)))
    assert token_counts.count_tokens(frame(spark, []), token_counts.piece_model_path()).collect() == []


def test_longest_match_on_random_vocabularies():
    rng = random.Random(11)
    for _ in range(150):
        begins, rest = ({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(0, 7))} for _ in range(2))
        match = token_counts.LongestMatch(sorted(begins), sorted(rest))
        for _ in range(40):
            word, at, n = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))), 0, 0
            while at < len(word):
                end = next((e for e in range(len(word), at, -1) if word[at:e] in (rest if at else begins)), None)
                if end is None:
                    at, n = len(word), 1
                else:
                    at, n = end, n + 1
            assert match.count(word) == n


# ---- suffix-array dedup ----------------------------------------------------------------------------------------------------
def brute_repeats(texts, length):
    blobs = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in blobs for i in range(len(b) - length + 1))
    out = []
    for b in blobs:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("length", [200, 40, 5])
def test_suffix_dedup_matches_brute_force(spark, corpus, length):
    rng = random.Random(12)
    passage = words(rng, 60)
    texts = [*corpus, *(words(rng, rng.randrange(40)) + passage + words(rng, rng.randrange(40)) for _ in range(12)), "é" * 300, "ab" * 150, "a" * 201, "a" * 200]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, texts), length).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, length)


@pytest.mark.parametrize("length", [248, 249, 255, 256, 300])
def test_suffix_dedup_of_long_strings(spark, length):
    rng = random.Random(14)
    passage = words(rng, 90)
    texts = [words(rng, 60), *(words(rng, rng.randrange(30)) + passage[rng.randrange(40):] + words(rng, rng.randrange(30)) for _ in range(4)), "a" * 620, "ab" * 200]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, texts), length).collect()}
    expected = brute_repeats(texts, length)
    assert [got[i] for i in range(len(texts))] == expected and sum(e[1] > 0 for e in expected) > 3


def test_suffix_dedup_length_has_a_range(spark):
    for length in (0, 65_001):
        with pytest.raises(ValueError):
            suffix_dedup.remove_repeats(frame(spark, ["a"]), length)


def test_suffix_dedup_odd_rows(spark):
    long = "".join(random.Random(13).choice("abcdefgh ") for _ in range(400))
    got = suffix_dedup.remove_repeats(frame(spark, [long, long, None], ids=[4, 4, None]), digest=True).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == {(4, 400): 2, (None, 0): 1}
    got = suffix_dedup.remove_repeats(frame(spark, [long, "x" + long], ids=[None, None])).collect()
    assert sorted(r.n_removed for r in got) == [400, 400]
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []


def test_suffix_dedup_of_a_key_larger_than_a_batch(spark, monkeypatch):
    """A passage shorter than a string, between unlike words, gives one key many distinct pieces; runs give long ones."""
    rng = random.Random(15)
    passage = words(rng, 20)[:60]
    texts = [f"{words(rng, 30)} {passage} {words(rng, 30)}" for _ in range(60)]
    texts += [*texts[:5], *(t[7:] + "x" for t in texts[5:9]), *("a" * n for n in (150, 150, 90, 5000)), "ab" * 700, None]
    sizes, sort = [], suffix_dedup.repeated_in_shards
    by_string, split = suffix_dedup.repeated_by_string, []

    def seen(pieces, *a):
        sizes.extend(r.size for r in pieces.groupBy("key").agg(F.sum(F.length("data")).alias("size")).collect())
        return sort(pieces, *a)

    def strings(pieces, *a):
        split.append(pieces.count())
        return by_string(pieces, *a)

    monkeypatch.setattr(suffix_dedup, "repeated_in_shards", seen)
    monkeypatch.setattr(suffix_dedup, "repeated_by_string", strings)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, texts), 80, shard_bytes=2000).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, 80)
    assert split[0] > 60 and max(sizes) <= 2000


def test_suffix_dedup_batches_of_whole_keys(spark, corpus):
    whole, cut = (sorted(suffix_dedup.remove_repeats(frame(spark, corpus), 40, digest=True, shard_bytes=b).collect(), key=str) for b in (8 << 20, 700))
    assert whole == cut


def test_induced_sorting_refuses_positions_over_32_bits(monkeypatch, tmp_path):
    import numpy as np

    from hourcast.llm import induced
    monkeypatch.setattr(induced, "_TUPLE", np.dtype([("pos", "u1"), ("lcp", "u1")]))
    text = np.frombuffer(b"a" * 300 + bytes([induced.SEPARATOR, induced.END]) + bytes([induced.PAD]) * (5 + induced.SPARE), np.uint8)
    with pytest.raises(ValueError, match="32 bits"):
        induced.repeated_starts(text, str(tmp_path), 5, np.ones(302, bool))


def test_induced_sorting_with_queues_on_disk(tmp_path, monkeypatch):
    import numpy as np

    from hourcast.llm import induced
    monkeypatch.setattr(induced, "BLOCK", 16)
    rng = random.Random(14)
    for trial in range(80):
        sigma, depth = rng.choice([1, 2, 3, 20]), rng.choice([1, 2, 5, 8, 16, 40])
        pieces = [bytes(rng.randrange(sigma) for _ in range(rng.randrange(1, 80))) for _ in range(rng.randrange(1, 9))]
        body = b"".join(bytes(b + 2 for b in p) + bytes([induced.SEPARATOR]) for p in pieces) + bytes([induced.END])
        text = np.frombuffer(body + bytes([induced.PAD]) * (depth + induced.SPARE), np.uint8)
        valid = np.array([induced.SEPARATOR not in body[i:i + depth] and len(body) - 1 - i >= depth for i in range(len(body))])
        seen = Counter(body[i:i + depth] for i in np.flatnonzero(valid))
        folder = tmp_path / str(trial)
        folder.mkdir()
        got = induced.repeated_starts(text, str(folder), depth, valid)
        assert got.tolist() == [bool(v) and seen[body[i:i + depth]] > 1 for i, v in enumerate(valid)]


# ---- a worker's memory -----------------------------------------------------------------------------------------------
def test_a_worker_lets_an_idle_bpe_coder_go(monkeypatch):
    class Made:
        def __init__(self, source):
            self.source = source

    monkeypatch.setattr(bpe, "Coder", Made)
    monkeypatch.setattr(bpe, "IDLE_S", 0.3)
    monkeypatch.setattr(bpe, "_coders", {})
    first = bpe._coder("rules")
    bpe._rest()
    assert bpe._coder("rules") is first  # the next task comes in time
    time.sleep(0.8)
    assert bpe._coder("rules") is first  # and keeps it as long as it runs
    bpe._rest()
    time.sleep(1.5)
    assert not bpe._coders

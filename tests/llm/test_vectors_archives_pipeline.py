"""Vector operators, archives and the pipeline against brute force."""
import gzip
import hashlib
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from hourcast.llm import embedding_dedup, hnsw, warc
from hourcast.llm.components import forest
from hourcast.llm.store import new_path
from .test_text_operators import brute_components, brute_lines, frame

VECTORS = "vec_id long, embedding array<float>, label int, n long, rep long, h1 string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, 2, "x") for i, v, l in rows], VECTORS).repartition(3)


def clustered(rng, n, dim=16):
    centres = rng.normal(size=(8, dim))
    x = (centres[rng.integers(0, 8, n)] + 0.25 * rng.normal(size=(n, dim))).astype(np.float32)
    x[n // 2:n // 2 + 30] = x[0]
    return x


BROKEN = [None, [], [0.0] * 16, [1.0, None] + [0.5] * 14, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15]


@pytest.mark.parametrize("threshold", [0.93, 0.8])
def test_near_embeddings_match_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 64)
    rng = np.random.default_rng(1)
    x = clustered(rng, 500)
    labels = [None if i % 50 == 49 else int(v) for i, v in enumerate(rng.integers(0, 3, 500))]
    rows = [(i, v.tolist(), l) for i, (v, l) in enumerate(zip(x, labels))] + [(600 + i, v, 0) for i, v in enumerate(BROKEN)] + [(700, [1.0, 2.0], 0), (701, [2.0, 4.0], 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_embeddings(vectors(spark, rows), threshold).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = [(i, j) for i in range(500) for j in range(i) if labels[i] is not None and labels[i] == labels[j] and u[i] @ u[j] >= threshold]
    degree, low = Counter(k for e in links for k in e), dict(forest(*zip(*links)))
    assert links and len(got) == len(rows)
    for i in range(500):
        assert got[i] == (degree[i], low.get(i, i), low.get(i, i) == i)
    assert all(got[600 + i] == (0, 600 + i, True) for i in range(len(BROKEN)))
    assert got[700] == (1, 700, True) and got[701] == (1, 700, False)


def test_near_embeddings_of_nothing_repeats_and_nulls(spark):
    assert embedding_dedup.near_embeddings(vectors(spark, [])).collect() == []
    got = embedding_dedup.near_embeddings(vectors(spark, [(3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (None, [1.0, 0.0], 1)])).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == {(3, 2, 2): 2, (2, 2, 2): 1, (None, 0, None): 1}


def test_nearest_has_recall_ties_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    x = clustered(rng, 3000)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(4000 + 20 * i, v, 0) for i, v in enumerate(BROKEN)]
    got = hnsw.nearest(vectors(spark, rows), shard_rows=1200, query_block=50).collect()
    exact = x.astype(np.float64) @ x.astype(np.float64).T
    by: dict = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(by) == list(range(0, 3000, 20))
    hits = 0
    for q, rows_ in by.items():
        rows_.sort()
        assert [r[0] for r in rows_] == list(range(1, 21))
        assert [(-s, v) for _, v, s in rows_] == sorted((-s, v) for _, v, s in rows_)
        assert all(abs(s - exact[q, v]) < 1e-9 and v != q for _, v, s in rows_)
        order = [v for v in np.lexsort((np.arange(3000), -exact[q])) if v != q][:20]
        hits += len(set(order) & {v for _, v, _ in rows_})
    assert hits / (20 * len(by)) >= 0.9


def test_nearest_with_few_rows(spark):
    assert hnsw.nearest(vectors(spark, [])).collect() == []
    got = hnsw.nearest(vectors(spark, [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (20, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0)])).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]


# ---- archives ------------------------------------------------------------------------------------------------------------
def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, date string").repartition(4)


def page_rows():
    long = "<p>" + "ü" * 600 + "</p>"
    return [(1, "http://a/x y", long), (2, "http://b", long), (9, None, long), (3, "http://c", "<b>short</b>"), (4, "http://d", "<b>short</b>"), (5, "http://e", None),
            (6, "http://f", ""), (7, "http://g#page_id=12", "WARC/1.0\r\n\r\nHTTP/1.1 200\r\n\r\n" * 60), (8, "http://h", "line\n" * 50_000), (10, "http://i", "a" * 999), (11, "http://j", "a" * 999), (12, "http://k", "b" * 1000), (13, "http://l", "b" * 1000)]


def test_archived_pages_come_back(spark):
    rows = page_rows()
    got = {r.page_id: r for r in warc.archive_pages(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    last: dict = {}
    for i, _, h in rows:
        last[h] = max(i, last.get(h, i))
    for i, _, h in rows:
        body = (h or "").encode()
        revisit = len(body) >= 1000 and last[h] != i
        r = got[i]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last[h] if revisit else None)
        assert r.payload is None if revisit else bytes(r.payload) == body


def test_archives_of_nothing_nulls_and_repeats(spark):
    assert warc.archive_pages(pages(spark, [])).collect() == []
    same = "z" * 1500
    got = warc.archive_pages(pages(spark, [(1, "u", same), (1, "u", same), (None, "u", same), (None, "v", None)])).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got) == {(1, "response", None): 2, (None, "revisit", 1): 1, (None, "response", None): 1}


def test_both_arc_versions_and_warc_headers(spark, tmp_path):
    arc, out = new_path(spark, "arc"), new_path(spark, "warc")
    warc.write_arc(pages(spark, page_rows()), arc)
    blobs = [zlib.decompress(bytes(r.content), 31) for r in warc._archives(spark, arc).collect()]
    versions = {b.split(b"\n")[1][:1] for b in blobs if b}
    assert versions == {b"1", b"2"}
    assert sum(len(list(warc.parse_arc(b))) for b in blobs if b) == len(page_rows())
    warc.convert_arc(spark, arc, out)
    heads = [f for r in warc._archives(spark, out).collect() for f, _ in warc.parse_warc(zlib.decompress(bytes(r.content), 31))]
    assert len({h["warc-record-id"] for h in heads}) == len(heads)
    assert all(uuid.UUID(h["warc-record-id"][10:-1]) and h["warc-date"] == "2020-01-01T00:00:00Z" for h in heads)
    ids = {h["warc-record-id"] for h in heads if h["warc-type"] == "response"}
    assert all(h["warc-refers-to"] in ids for h in heads if h["warc-type"] == "revisit")


@pytest.mark.parametrize("version", [1, 2])
def test_archives_of_others(spark, tmp_path, version):
    """Hand-made .arc.gz with a gzip member per record and payloads that are no UTF-8, converted, and read from .warc.gz."""
    image, latin = bytes(range(256)) * 3 + b"\r\n\r\n\n", "caf\xe9".encode("latin-1")
    head = b"HTTP/1.0 200 OK\r\nContent-Type: image/png\r\n\r\n"
    rest = "" if version == 1 else " 200 - - 0 x.arc"
    rows = [("http://a/i.png", "192.0.2.7", "image/png", head + image), ("dns:a", "0.0.0.0", "text/dns", latin), ("http://b/?#page_id=x", "192.0.2.8", "no-type", latin)]
    about = f"{version} 0 x\n{warc.ARC_FIELDS[version]}\n".encode()
    records = [f"filedesc://x.arc 0.0.0.0 19990102030405 text/plain{rest} {len(about)}\n".encode() + about + b"\n"]
    records += [f"{u} {ip} 19990102030405 {mime}{rest} {len(block)}\n".encode() + block + b"\n" for u, ip, mime, block in rows]
    arc, out, again = tmp_path / "arc", tmp_path / "warc", tmp_path / "again"
    arc.mkdir()
    again.mkdir()
    (arc / "IA-0001.arc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    warc.convert_arc(spark, str(arc), str(out))
    found = [x for r in warc._archives(spark, str(out)).collect() for x in warc.parse_warc(gzip.decompress(bytes(r.content)))]
    heads = {f["warc-target-uri"]: (f["warc-type"], f["content-type"], f.get("warc-ip-address"), block) for f, block in found}
    assert heads == {"http://a/i.png": ("response", "application/http; msgtype=response", "192.0.2.7", head + image),
                     "dns:a": ("resource", "text/dns", None, latin), "http://b/?#page_id=x": ("resource", "application/octet-stream", "192.0.2.8", latin)}
    assert len({f["warc-record-id"] for f, _ in found}) == 3
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    members = ["\r\n".join(["WARC/1.0", *(f"{k}: {v}" for k, v in f.items())]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n" for f, block in found]
    (again / "x.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in [info, *members]))
    got = {r.url: (r.record_type, bytes(r.payload)) for r in warc.read_warc(spark, str(again)).collect()}
    assert got == {None: ("warcinfo", b"ok"), "http://a/i.png": ("response", image), "dns:a": ("resource", latin), "http://b/?#page_id=x": ("resource", latin)}


def test_gzip_file_cut_short_is_an_error():
    whole = gzip.compress(b"a" * 10) + gzip.compress(b"b" * 10)
    assert warc._inflated(memoryview(whole)) == b"a" * 10 + b"b" * 10
    with pytest.raises(ValueError, match="without end"):
        warc._inflated(memoryview(whole[:-3]))


@pytest.mark.parametrize("blob,what", [(b"x 1\nab", "version block"), (b"filedesc://a 0 0 t 9\n1 0 x\nab", "shorter"), (b"filedesc://a 0 0 t 6\n1 0 x\n\nhttp://x 0 text 2\nab\n", "fields")])
def test_broken_arc_files_are_errors(blob, what):
    with pytest.raises(ValueError, match=what):
        list(warc.parse_arc(blob))


# ---- the pipeline ----------------------------------------------------------------------------------------------------------
def test_pipeline_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: f"q{rng.randrange(500)}"
    texts, labels = [], []
    for i in range(240):
        s = [" ".join(word() for _ in range(12)) for _ in range(rng.randrange(2, 6))]
        if i % 6 == 1:
            s[0] += " vilest"
        texts.append(".\n".join(s))
        labels.append((i, 1, int(i % 6 == 1)))
    texts += [texts[0], texts[2] + " more", None, "", "Repeated line of the whole site.\nown a", "Repeated line of the whole site.\nown b", "Repeated line of the whole site.\nown c"]
    sf = str(tmp_path)
    frame(spark, texts).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, stages = docs.columns, corpus_pipeline.STAGES
    assert [n for n, _ in stages] == ["toxicity", "line_dedup", "ngram_jaccard_join", "mix_sources", "bpe"]

    clean = stages[0][1](spark, docs, sf).cache()
    bad = {i for i, t in enumerate(texts) if t and "vilest" in t}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == set(range(len(texts))) - bad

    lines = stages[1][1](spark, clean, sf).cache()
    wanted = brute_lines([(r.doc_id, r.text) for r in clean.collect()])
    assert lines.columns == columns and sorted((r.doc_id, r.text or "") for r in lines.collect()) == sorted((i, t) for i, _, _, t in wanted)

    single = stages[2][1](spark, lines, sf).cache()
    rows = lines.collect()
    groups = brute_components([r.text for r in rows], [r.doc_id for r in rows], 5, 80)
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in groups})

    mixed = stages[3][1](spark, single, sf).cache()
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in single.collect()}
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3

    from tokenizers import Tokenizer
    library = Tokenizer.from_file(corpus_pipeline.word_bpe_path())
    text_of = {r.doc_id: r.text for r in mixed.collect()}
    coded = stages[4][1](spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in coded) == Counter(r.doc_id for r in mixed.collect())
    assert all(r.ids == library.encode(text_of[r.doc_id] or "", add_special_tokens=False).ids for r in coded)
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in whole) == sorted((r.doc_id, r.ids_sha256) for r in coded)

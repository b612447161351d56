"""Sharding, pieces, vectors, archives, toxicity and the pipeline."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import neighbours, pieces, queries, shards, toxicity, warc
from fleetgauge.llm.arrays import mix
from fleetgauge.llm.scratch import Scratch


def test_shards(docs_of):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randrange(400)) for i in range(400)] + [(7, "y" * 30)] * 100 + [(8, "z" * 5000), (None, None)]
    got = shards.assign(docs_of(rows), limit=1000).collect()
    bits = lambda i: format(int(hashlib.md5(b"" if i is None else str(i).encode()).hexdigest()[:15], 16), "060b")
    total = Counter()
    for i, t in rows:
        for k in range(61):
            total[bits(i)[:k]] += len(t or "")
    assert len(got) == len(rows)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.n_bytes
        fitting = next((bits(r.doc_id)[:k] for k in range(61) if total[bits(r.doc_id)[:k]] <= 1000), None)
        assert r.shard == fitting if fitting is not None else r.shard.startswith(bits(r.doc_id) + "/")
    assert all(sizes[r.shard] == r.shard_bytes and r.fits == (r.shard_bytes <= 1000) for r in got)
    assert [r.doc_id for r in got if not r.fits] == [8]
    assert shards.assign(docs_of([]), limit=10).count() == 0


def tiny_vocabulary():
    listed = [("▁", -1), ("a", -2), ("b", -1.5), ("ab", -1), ("▁a", -2.5), ("ba", -1.2)]
    listed = [(p.encode(), s, pieces.NORMAL) for p, s in listed]
    return pieces.vocabulary(listed + [(b"<0x%02X>" % i, 0.0, pieces.BYTE) for i in range(256)], True)


def segmentations(text, vocab):
    out, known = [], {vocab.surface[i].decode(): vocab.log_weight[i] for i in range(6)}

    def go(at, path, weight):
        if at == len(text):
            out.append((tuple(path), weight))
        for piece, w in known.items():
            if text.startswith(piece, at):
                go(at + len(piece), [*path, piece], weight + w)

    go(0, [], 0.0)
    total = np.logaddexp.reduce([w for _, w in out])
    return {path: np.exp(w - total) for path, w in out}


def test_samples_follow_the_lattice():
    vocab, text, n = tiny_vocabulary(), " ab ba", 20_000
    prob = segmentations(text, vocab)
    data = np.frombuffer((text * n).encode(), dtype=np.uint8)
    seeds = mix(np.arange(n, dtype=np.uint64) + np.uint64(3))
    sampler = pieces.Sampler(data, np.arange(n + 1) * len(text), seeds, pieces.Lattices(vocab))
    paths, threshold = sampler.samples(3)
    drawn = []
    for p in paths:
        ids, first = sampler.ids(p)
        drawn.append([tuple(vocab.surface[i].decode() for i in ids[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)])
        assert np.allclose(np.exp(p.log_prob), [prob[x] for x in drawn[-1]])
    assert all(len(set(x)) == 3 for x in zip(*drawn, strict=True))
    assert (paths[0].score > paths[1].score).all() and (paths[2].score > threshold).all()
    ones, pairs = Counter(drawn[0]), Counter(zip(drawn[0], drawn[1], strict=True))
    expected = {(a, b): n * prob[a] * prob[b] / (1 - prob[a]) for a in prob for b in prob if a != b}
    assert sum((ones[a] - n * p) ** 2 / (n * p) for a, p in prob.items()) < 25
    assert sum((pairs[k] - e) ** 2 / e for k, e in expected.items()) < 70


def test_six_samples_have_the_exact_inclusion():
    """How often each segmentation is among six drawn without replacement, one after another."""
    vocab, text, n, k = tiny_vocabulary(), " abab", 30_000, 6
    prob = segmentations(text, vocab)
    assert len(prob) > k + 1
    names = list(prob)
    expected = Counter()

    def draw(left, taken, chance):
        if len(taken) == k:
            expected.update({names[i]: chance for i in taken})
            return
        for i in range(len(names)):
            if i not in taken:
                draw(left - prob[names[i]], (*taken, i), chance * prob[names[i]] / left)

    draw(1.0, (), 1.0)
    data = np.frombuffer((text * n).encode(), dtype=np.uint8)
    sampler = pieces.Sampler(data, np.arange(n + 1) * len(text), mix(np.arange(n, dtype=np.uint64) + np.uint64(11)), pieces.Lattices(vocab))
    seen = Counter()
    for p in sampler.samples(k)[0]:
        ids, first = sampler.ids(p)
        seen.update(tuple(vocab.surface[i].decode() for i in ids[a:b]) for a, b in zip(first[:-1], first[1:], strict=True))
    assert sum(seen.values()) == k * n
    for x in names:
        assert abs(seen[x] - n * expected[x]) < 5 * np.sqrt(n * expected[x] * (1 - expected[x])) + 1
    with pytest.raises(ValueError, match="256"):
        pieces.uniform(np.ones(1, np.uint64), 300, 0, 0)


def test_pieces_keep_lattices_of_words_met_again():
    """Words met once take no room of a worker; a full store does not change what is built."""
    vocab = tiny_vocabulary()
    data = np.frombuffer(" ab abb é".encode(), np.uint8)
    start, end = np.array([0, 3, 7]), np.array([3, 7, 10])
    hashes = np.array([3, 5, 9], np.uint64)
    whole, nodes = pieces.lattice(data, start, end, vocab)
    for kept_chars, sizes in ((100, [0, 9, 9]), (3, [0, 0, 0])):
        lattices = pieces.Lattices(vocab, kept_chars)
        for size in sizes:
            found = lattices.of(data, start, end, hashes)
            assert lattices.nodes == size
            for a, b in zip(found, nodes, strict=True):
                edges = lambda lat, n: slice(lat.head[n], lat.head[n] + lat.options[n])
                for name in ("piece", "log_p", "cumulative"):
                    assert getattr(lattices.all, name)[edges(lattices.all, a)].tolist() == getattr(whole, name)[edges(whole, b)].tolist()


def test_fewer_segmentations_than_asked():
    vocab = tiny_vocabulary()
    sampler = pieces.Sampler(np.frombuffer(b" b", np.uint8), np.array([0, 2]), np.array([5], np.uint64), pieces.Lattices(vocab))
    paths, threshold = sampler.samples(3)
    assert [len(p.text) for p in paths] == [1, 0, 0] and threshold[0] == -np.inf


ODD = ["", None, "a", "  two  spaces ", "line\nline\ttab", "▁ literal", "emoji 🙂 漢字", "x" * 3000, "\x00\x7f", "é" * 40]


def test_encoding_round_trip(docs_of):
    docs = docs_of(list(enumerate(ODD)) + [(2, "a"), (None, "no id")])
    coded = pieces.encode(docs, queries.PIECE_MODEL, k=3)
    rows = pieces.decode(coded, queries.PIECE_MODEL).collect()
    texts = dict(enumerate(ODD)) | {None: "no id"}
    assert all(r.round_trip and r.decoded == (texts[r.doc_id] or "") for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r["sample"], tuple(r.pieces)))
    assert by_id[0] == [(1, ())] and by_id[1] == [(1, ())]
    assert sorted(by_id[2]) == sorted(2 * sorted(set(by_id[2])))  # equal rows, equal samples
    assert len({p for _, p in by_id[3]}) == 3
    again = pieces.encode(docs.repartition(5), queries.PIECE_MODEL, k=3).collect()
    assert sorted((str(r.doc_id), r["sample"], r.pieces) for r in again) == sorted(
        (str(r.doc_id), r["sample"], r.pieces) for r in rows
    )
    assert all(0 < r.inclusion <= 1 and r.log_prob <= 0 for r in rows)


def test_vectors(spark):
    rng = np.random.default_rng(1)
    rows = []
    for group in range(6):
        center = rng.standard_normal(16)
        rows += [(len(rows) + k, (center + 0.02 * rng.standard_normal(16)).tolist(), group % 2) for k in range(15)]
    rows += [(500 + k, rng.standard_normal(16).tolist(), k % 2) for k in range(40)]
    rows += [(900, rows[0][1], 0), (0, rows[0][1], 0), (901, None, 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0)]
    rows += [(904, [None] * 16, 0), (905, rows[0][1], None), (906, [1e200] * 16, 1), (907, [2e200] * 16, 1), (None, rows[1][1], 0)]
    rows += [(908, [1.0], 0), (909, [2.0], 0)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, node string, part int")
    got = neighbours.near_duplicates(table, leaf=16).collect()
    unit = []
    for _, v, label in rows:
        bad = v is None or label is None or any(x is None or not np.isfinite(x) for x in v) or not any(v)
        unit.append(None if bad else np.array(v) / max(map(abs, v)))
    unit = [u if u is None else u / np.linalg.norm(u) for u in unit]
    linked = lambda a, b: (
        a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2]
        and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98
    )
    n, root = len(rows), list(range(len(rows)))
    links = [sum(linked(a, b) for b in range(n)) for a in range(n)]
    for a in range(n):
        for b in range(n):
            if linked(a, b):
                root = [root[a] if r == root[b] else r for r in root]
    want = []
    for a, (i, *_) in enumerate(rows):
        ids = [rows[b][0] for b in range(n) if root[b] == root[a] and rows[b][0] is not None]
        least = min(ids, default=None) if unit[a] is not None else i
        want.append((str(i), links[a], str(least), least == i if unit[a] is not None else True))
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == sorted(want)
    assert neighbours.near_duplicates(table.limit(0)).count() == 0


def test_vectors_of_one_dense_cluster(spark):
    """More near copies than a leaf holds, and tight groups whose lists hold none but their own."""
    rng = np.random.default_rng(4)
    base, side = rng.standard_normal(16), rng.standard_normal(16)
    rows = [(base + 1e-6 * rng.standard_normal(16)).tolist() for _ in range(150)]
    rows += [(base + 0.03 * side + 1e-6 * rng.standard_normal(16)).tolist() for _ in range(40)]
    rows += rng.standard_normal((60, 16)).tolist()
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = neighbours.near_duplicates(table.withColumn("label", F.lit(0)), leaf=32).collect()
    unit = np.array([np.array(v) / np.linalg.norm(v) for v in rows])
    linked = (unit @ unit.T >= 0.98) & ~np.eye(len(rows), dtype=bool)
    least = np.arange(len(rows))
    for _ in rows:
        least = np.minimum(least, np.where(linked, least, len(rows)).min(axis=1))
    assert linked[:190, :190].sum() == 190 * 189
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [
        (i, linked[i].sum(), least[i], least[i] == i) for i in range(len(rows))
    ]


def test_archive_verifies_the_strong_digest(spark):
    pages = spark.createDataFrame([(1, "u", "one")], "page_id long, url string, html string")
    archive = warc.write(pages, Scratch(spark, "strong"))
    assert [r.verified for r in warc.read(archive).collect()] == [True]
    other = F.sha2(F.lit(b"two"), 256)
    wrong = warc.Archive(archive.headers.withColumn("sha256", other), archive.payloads.withColumn("sha256", other))
    assert [r.verified for r in warc.read(wrong).collect()] == [False]


def test_archive_is_read_from_its_headers(spark):
    """The date is there, a URL stays on its line, and what a header says wrongly shows."""
    import datetime as dt

    rows = [(1, "http://a/\r\nWARC-Type: x", "one"), (2, "u", "one"), (3, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.write(pages, Scratch(spark, "headers"), date=dt.datetime(2024, 2, 3, 4, 5, 6))
    records = {r.page_id: r for r in warc.read(archive).collect()}
    assert {i: (r.record_type, r.refers_to, r.verified) for i, r in records.items()} == {
        1: ("response", None, True), 2: ("revisit", 1, True), 3: ("response", None, True),
    }
    for r in records.values():
        lines = bytes(r.header).decode().split("\r\n")
        assert lines[0] == "WARC/1.1" and lines[-2:] == ["", ""] and all(": " in x for x in lines[1:-2])
        fields = dict(x.split(": ", 1) for x in lines[1:-2])
        assert len(fields) == len(lines) - 3 and fields["WARC-Date"] == "2024-02-03T04:05:06Z"
    assert b"http://a/%0D%0AWARC-Type: x" in bytes(records[1].header)
    text = F.col("header").cast("string")
    swapped = F.replace(text, F.lit("WARC-Type: revisit"), F.lit("WARC-Type: response"))
    forged = F.replace(text, F.lit("sha1:"), F.lit("sha1:A"))
    of = lambda header: warc.read(warc.Archive(archive.headers.withColumn("header", header.cast("binary")), archive.payloads))
    assert {r.record_type for r in of(swapped).collect()} == {"response"}
    assert {r.verified for r in of(forged).collect()} == {False}
    assert warc.read(warc.write(pages.limit(0), Scratch(spark, "none"))).collect() == []


def test_archive(spark):
    rows = [(3, "http://a/", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (5, "u", ""), (None, "u", "only"), (9, "u", "é" * 50000)]
    rows += [(None, "u", "<p>é</p>"), (1, None, "<p>é</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string")
    archive = warc.write(pages, Scratch(spark, "test"))
    records = warc.read(archive).withColumn("record", warc.record_bytes()).collect()
    assert archive.payloads.count() == len({r[2] or "" for r in rows})
    assert len(records) == len(rows) and all(r.verified for r in records)
    for r in records:
        payload = bytes(r.payload)
        assert r.sha1 == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids = [i for i, _, html in rows if (html or "") == payload.decode() and i is not None]
        first = min(ids, default=None)
        assert r.record_type == ("response" if r.page_id == first else "revisit")
        assert r.refers_to == (None if r.record_type == "response" else first)
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        size = int(head.rpartition(b"Content-Length: ")[2])
        assert block == (payload if r.record_type == "response" else b"") + b"\r\n\r\n" and size == len(block) - 4
    small = warc.write(pages, Scratch(spark, "test"), min_bytes=20)
    assert warc.read(small).where("record_type = 'revisit'").count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    words = [a + b for a in ("lo", "mi", "ka", "su") for b in ("ra", "ne", "tol", "vi", "sem")]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        text = [rng.choice(words) for _ in range(60)]
        if toxic:
            for _ in range(5):
                text[rng.randrange(60)] = rng.choice(["grobian", "grobling", "stinkwicht"]) + rng.choice(["", "er", "s"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), "x"))
    return rows, labels


def test_toxicity(spark, docs_of, labelled):
    rows, labels = labelled
    labels = spark.createDataFrame([*labels, (None, 1, "x"), (3, None, "x"), (4, 7, "x")], "doc_id long, toxic int, text string")
    docs = docs_of([*rows, (1000, None), (1001, ""), (None, "x"), (5, rows[5][1])])
    scored = toxicity.score(docs, labels, trees=5, depth=3).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    held = [r for r in scored if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert all(r.held_out == (__import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert next(r for r in scored if r.doc_id == 1001).predicted == 0


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1), (3, 1)]])
def test_toxicity_without_both_kinds(spark, docs_of, labels):
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = {r.score for r in toxicity.score(docs_of([(1, "a"), (2, None)]), labels).collect()}
    assert len(scores) == 1
    assert toxicity.score(docs_of([]), labels).count() == 0


def test_pipeline(spark, tmp_path, labelled):
    import corpus_pipeline

    rows, labels = labelled
    item = " ".join(f"q{i}" for i in range(20))
    copy = " ".join(f"c{i}" for i in range(120))
    extra = [(2000, item), (2001, copy), (2002, copy), (2003, None), (2004, "é " * 300 + "x"), (2005, "y" + "é " * 300)]
    docs = [(i, t, "en", "s", len(t or ""), 7) for i, t in rows + extra]
    columns = "doc_id long, text string, lang string, source string, n_chars long, key int"
    spark.createDataFrame(docs, columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, text string").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, str(tmp_path))
        assert out.columns == table.columns and out.schema.simpleString() == table.schema.simpleString()
        out.write.parquet(f"{tmp_path}/{name}")
        table = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r.doc_id: r.text for r in table.collect()})
    after_toxicity, after_copies, after_cuts, clean = kept
    assert np.mean([i % 5 != 0 for i in after_toxicity if i < 600]) > 0.97 and 1 in after_toxicity
    assert {2001, 2002} & after_copies.keys() == {2001}
    assert after_cuts.keys() == after_copies.keys()
    assert after_cuts[2001] == copy and after_cuts[2003] == ""
    assert 2000 in after_cuts and 2000 not in clean and len(clean) == len(after_cuts) - 1
    coded = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path))
    assert coded.where(~F.col("round_trip")).count() == 0
    assert coded.select("doc_id").distinct().count() == len(clean)


def test_training_rows_are_bounded_and_columns_may_clash(spark, monkeypatch):
    """One labelled id on most texts does not make them all training rows; the input may have a column of any name."""
    rng = random.Random(4)
    rows = [(1, f"text {i} {rng.random()}", i, 0.5) for i in range(3000)] + [(i, f"you stupid idiot {i}", 3, 0.1) for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, row int, Toxicity_Score double")
    labels = spark.createDataFrame([(i, int(i > 1)) for i in range(1, 40)], "doc_id int, toxic int")
    kept = []
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name, **kw: kept.append((name, keep(self, df, name, **kw))) or kept[-1][1])
    scored = toxicity.with_score(docs, labels, max_training=50)
    assert scored.columns == ["doc_id", "text", "row", toxicity.SCORE] and scored.count() == len(rows)
    assert dict(kept)["training"].count() <= 100
    assert toxicity.score(docs, labels, max_training=50).columns == ["doc_id", "held_out", "score", "predicted"]


def test_the_vector_audit_tells(spark, monkeypatch):
    """Rare links are looked for among more classes; links that no search finds are an error, not a result."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(16).tolist(), 0) for i in range(150)]
    rows += [(200 + i, (np.array(rows[i][1]) * 2 + 1e-6).tolist(), 0) for i in range(10)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(neighbours, "AUDIT", 4)
    got = neighbours.near_duplicates(table, leaf=32).collect()
    assert {r.recall for r in got} == {1.0} and got[0].audited_links >= 6
    assert sum(r.n_links for r in got) == 20 and sum(not r.kept for r in got) == 10
    nothing = "node long, other long, sim double, joins boolean, place int"
    monkeypatch.setattr(neighbours, "_searched", lambda classes, *_: spark.createDataFrame([], nothing))
    with pytest.raises(ArithmeticError, match="0 of"):
        neighbours.near_duplicates(table, leaf=32)
    alone = neighbours.near_duplicates(table.where("vec_id < 150"), leaf=32).collect()
    assert {(r.audited_links, r.recall) for r in alone} == {(0, None)}


def test_stages_keep_names_and_types(spark, tmp_path, labelled):
    """A column of the score's name, and ids and counts that are ints, come out as they went in."""
    import corpus_pipeline

    rows, labels = labelled
    spark.createDataFrame(labels, "doc_id long, toxic int, row string").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([(*r, len(r[1]), 0.5) for r in rows], "doc_id int, text string, n_chars int, toxicity_score double")
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.cut_repeats):
        out = stage(spark, docs, str(tmp_path))
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
        assert 0 < out.count() <= docs.count()

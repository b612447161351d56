"""The operators on documents against brute force on small tables with every odd case."""

import hashlib
import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import components, licences, minhash, phrase_index, reference_parse, suffix_repeats, windows
from fleetgauge.llm.scratch import Scratch

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nü", "zr") for b in ("st", "en", "ar", "ol")]
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sample_rows():
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))
    passage, whole = prose(70), prose(90)
    rows = [(i, prose(rng.randrange(5, 120))) for i in range(12)]
    rows += [(20, whole), (21, whole), (22, whole.replace("ka", "KA", 1)), (23, f"{prose(30)} {passage} {prose(9)}")]
    rows += [(24, f"{passage}\n{prose(40)}"), (25, passage + " " + passage), (26, "of " * 400), (27, "of " * 300)]
    rows += [(28, None), (29, ""), (30, " \t\n"), (31, "einzeln"), (32, "ein Wort"), (33, "é" * 250), (34, "é" * 260)]
    rows += [(None, whole), (None, None), (40, passage[:230]), (20, whole), (41, prose(4000)), (1, "another text of id one")]
    return rows


ROWS = sample_rows()


@pytest.mark.parametrize("group_bodies", [8192, 1])
def test_byte_repeats(docs_of, group_bodies):
    got = suffix_repeats.remove_repeats(docs_of(ROWS), group_bodies=group_bodies).collect()
    data = [(i, (t or "").encode()) for i, t in ROWS]
    seen = {}
    for _, b in data:
        for i in range(len(b) - 199):
            seen[b[i : i + 200]] = seen.get(b[i : i + 200], 0) + 1
    want = []
    for doc_id, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want.append((str(doc_id), len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == sorted(want)


def test_whole_characters_stay(docs_of):
    text = "a" + "é" * 150 + "b"
    got = suffix_repeats.remove_repeats(docs_of([(1, text), (2, "c" + "é" * 150)]), whole_chars=True, carry=["row"])
    for row in got.collect():
        assert bytes(row.kept).decode() in ("ab", "c")
        assert row.carried.row == 2.0


@pytest.mark.parametrize("group_bodies", [8192, 1])
def test_reference_parse(docs_of, group_bodies):
    got = reference_parse.remove_copied(docs_of(ROWS), group_bodies=group_bodies).collect()
    data = [(i, SPACED.findall(t or "")) for i, t in ROWS]
    order = lambda i: float("inf") if i is None else i
    first = {}
    for i, w in data:
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            first[key] = min(first.get(key, float("inf")), order(i))
    want = []
    for i, w in data:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < order(i):
                gone[k : k + 50] = [True] * 50
        want.append((str(i), len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == sorted(want)


@pytest.mark.parametrize("group_bytes", [4 << 20, 400])
def test_phrase_index(spark, docs_of, group_bytes):
    words = ALNUM.findall(ROWS[3][1])
    items = [(1, " ".join(words[2:20])), (1, " ".join(words[2:20])), (2, "Einzeln"), (3, None), (4, ""), (None, "einzeln")]
    items += [(10, re.sub("[a-z]", lambda m: m[0].upper(), " ".join(words[:13]))), (11, "nowhere at all"), (12, "another TEXT of id-one")]
    items = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    got = phrase_index.match(docs_of(ROWS), items, group_bytes=group_bytes).collect()
    windows = {}
    for r in items.collect():
        w = ALNUM.findall(low(r.text))
        if w and r.item_id is not None:
            n = min(13, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(r.item_id)
    want = []
    for i, t in ROWS:
        w = ALNUM.findall(low(t))
        hits, found = set(), set()
        for window, ids in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hits.update(range(k, k + len(window)))
                    found |= ids
        want.append((str(i), len(w), sorted(hits), sorted(found)))
    assert sorted((str(r.doc_id), r.n_words, list(r.hits), list(r["items"])) for r in got) == sorted(want)
    assert {i for r in got for i in r["items"]} == {1, 2, 10, 12}


def test_licences(docs_of):
    rows = [*ROWS, (50, "x\nReleased under the MIT License\ny"), (51, "released UNDER mit license the"), (52, "CC-BY-NC")]
    rows += [(53, "word " * 300 + "Licensed under the Apache License, Version 2.0" + " more" * 80), (54, "under the mit")]
    got = {(r.doc_id, r.n_words): r for r in licences.scan(docs_of(rows)).collect()}
    assert len(licences.scan(docs_of(rows)).collect()) == len(rows)
    by_id = {k[0]: v for k, v in got.items()}
    assert (by_id[50].base_labels, by_id[50].labels, by_id[50].n_base, by_id[50].first_word) == (["mit"], ["mit"], 1, 2)
    assert (by_id[51].base_labels, by_id[51].labels, by_id[51].score) == ([], ["mit"], 1.0)
    assert by_id[52].labels == ["cc-by-nc"] and by_id[52].last_word == 0
    assert by_id[53].labels == ["apache-2"] and by_id[53].first_word == 303
    assert (by_id[54].labels, by_id[54].score, by_id[54].first_word) == ([], 0.0, None)
    assert (by_id[28].n_words, by_id[28].labels) == (0, [])


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the BSD License", []),
        ("Licensed under the Mozilla Public License, Version 2.0", []),
        ("Licensed under the Apache License, Version 1.0", []),
        ("Licensed under CC BY 4.0", []),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1", []),
        ("This work is licensed under the GNU Lesser General Public License, version 3", []),
        ("This work is licensed under the GNU General Public License, version 2", []),
        ("This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0", []),
        ("MIT released the results under the terms of a license", []),
        ("Released under MIT License", ["mit"]),
        ("Licensed under the Apache License 2.0", ["apache-2"]),
        ("This is licensed under the GNU General Public License, version 3", ["gpl-3"]),
        ("This is free software: modify it under the terms of the GNU General Public License, either version 3", ["gpl-3"]),
        ("Licensed under the Apache License, v. 2.0", ["apache-2"]),
        ("Licensed under CC BY-NC 4.0", ["cc-by-nc"]),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0", ["mpl-2"]),
    ],
)
def test_other_licences_have_no_label(docs_of, text, labels):
    assert [r.labels for r in licences.scan(docs_of([(1, f"x\n{text}\ny")])).collect()] == [labels]


@pytest.mark.parametrize("words_before", [0, 43, 90, 999])
def test_licences_wrapped_over_lines(docs_of, words_before):
    wrapped = [(k, textwrap.fill(text, 40).replace("\n", "\n * ")) for k, (_, text, *_) in enumerate(licences.TEMPLATES)]
    assert sum("\n" in text for _, text in wrapped) == 5
    rows = [(k, "word\n" * words_before + text + "\nword" * 60) for k, text in wrapped]
    got = {r.doc_id: (r.labels, r.score) for r in licences.scan(docs_of(rows)).collect()}
    assert got == {k: ([label], 1.0) for k, (label, *_) in enumerate(licences.TEMPLATES)}


def similar(rows, size, percent):
    sets = []
    for _, t in rows:
        w = SPACED.findall(low(t))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root = [root[a] if r == root[b] else r for r in root]
    return sets, root


@pytest.mark.parametrize("block", [minhash.BLOCK, 3])
def test_near_duplicates(docs_of, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(3)
    base = SPACED.findall(ROWS[2][1] + " " + ROWS[5][1] + " " + ROWS[7][1])
    rows = list(ROWS)
    for k in range(40):  # a family whose members are partly linked, partly only through others
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(len(words))] = f"new{k}"
        rows.append((100 + k, " ".join(words)))
    rows = [(i, t) for i, t in rows if (i, t) != (1, "another text of id one")]
    got = minhash.near_duplicates(docs_of(rows), shingle=3, similarity=85).collect()
    sets, root = similar(rows, 3, 85)
    want = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[k] and rows[j][0] is not None]
        least = min(ids, default=None) if sets[k] else i
        want.append((str(i), len(sets[k]), str(least), least == i if sets[k] else True))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == sorted(want)
    kept = minhash.keep_first(docs_of(rows), shingle=3, similarity=85)
    assert kept.columns == docs_of(rows).columns
    assert kept.count() == len({(i, t) for (i, t), w in zip(rows, want, strict=True) if w[3]})


def test_texts_that_bands_chain_cost_in_proportion(docs_of, monkeypatch):
    """Each text shares bands with the next and links with none: nothing grows with the square of the chain."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    cells, seen = minhash._cells, []
    monkeypatch.setattr(minhash, "_cells", lambda *args: seen.append(cells(*args)) or seen[-1])
    size = {}
    for n in (500, 4000):
        rows = [(i, " ".join(f"w{k}" for k in range(15 * i, 15 * i + 64))) for i in range(n)]
        found = minhash.near_duplicates(docs_of(rows)).collect()
        assert len(found) == n and all(r.kept and r.component_id == r.doc_id for r in found)
        size[n] = seen[-1].count()
    assert 0 < size[500] and size[4000] <= 10 * size[500]


def test_links_that_only_other_members_of_a_bucket_show(docs_of):
    """Families that share a passage with one text, and so buckets, but link only among themselves."""
    shared = [f"s{k}" for k in range(60)]
    rows = [(0, " ".join(shared))]
    for family in range(30):
        own = [f"f{family}x{k}" for k in range(40)]
        rows += [(1 + 3 * family + i, " ".join([*shared, *own, *(f"e{i}y{k}" for k in range(i))])) for i in range(3)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(rows)).collect()}
    sets, root = similar(rows, 5, 80)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least.setdefault(r, i)
    assert got == {i: least[r] for (i, _), r in zip(rows, root, strict=True)}
    assert len(set(got.values())) == 31


def test_components_with_hubs(spark, monkeypatch):
    """Stars, chains between them, and a hub of middle rank; a hub's edges do not meet in one task."""
    rng = random.Random(5)
    links = [(10_000, k) for k in range(3000)] + [(5000, k) for k in range(4900, 5100) if k != 5000]
    links += [(20_000 + k, 20_001 + k) for k in range(40)] + [(20_000, 2999), (7, 7)]
    links += [(rng.randrange(30_000, 30_400), rng.randrange(30_000, 30_400)) for _ in range(300)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for x in {x for a, b in links if a != b for x in (a, b)}}
    frame = spark.createDataFrame(links, "a long, b long")
    got = components.components(frame, Scratch(spark, "test"), "test").collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    edges = frame.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    hubs = components._state(edges)[1]
    assert len(hubs.parts) == 2
    parts = hubs.split(edges, ["b"]).groupBy("a", "part").count().agg(F.max("count")).first()[0]
    assert parts < 100


def test_texts_of_equal_32_bit_hash(spark, docs_of):
    copied, own = " ".join(f"p{k}" for k in range(60)), " ".join(f"q{k}" for k in range(70))
    texts = lambda start, name: spark.range(200_000).select(F.concat(F.lit(f"{start} "), "id").alias(name))
    x, y = texts(copied, "x").join(texts(own, "y"), F.hash("x") == F.hash("y")).orderBy("x", "y").first()
    docs = docs_of([(1, copied), (None, x), (None, y)])
    assert sorted(r.text for r in minhash.keep_first(docs_of([(None, x), (None, y)])).collect()) == [x, y]
    assert y in {bytes(r.kept).decode() for r in suffix_repeats.remove_repeats(docs).collect()}
    got = {r.n_words: (r.n_removed, r.kept) for r in reference_parse.remove_copied(docs).collect()}
    assert got == {60: (0, copied), 61: (60, x.split()[-1]), 71: (0, y)}


def test_one_of_near_copies_without_id_is_kept(docs_of):
    base = " ".join(f"w{k}" for k in range(80))
    family = [(None, f"{base} {end}") for end in "abc"]
    kept = minhash.keep_first(docs_of([*family, family[0], (None, None), (None, ""), (None, "alone")])).collect()
    assert sorted(str(r.text)[:5] for r in kept) == ["", "None", "alone", "w0 w1"]
    kept = minhash.keep_first(docs_of([*family, (7, f"{base} d")])).collect()
    assert [r.doc_id for r in kept] == [7]


def test_empty_tables(spark, docs_of):
    docs, items = docs_of([]), spark.createDataFrame([], "item_id long, text string")
    assert suffix_repeats.remove_repeats(docs).count() == 0
    assert reference_parse.remove_copied(docs).count() == 0
    assert phrase_index.match(docs, items).count() == 0
    assert phrase_index.match(docs_of(ROWS), items).count() == len(ROWS)
    assert licences.scan(docs).count() == 0
    assert minhash.near_duplicates(docs).count() == 0


def test_digests_of_queries(spark, tmp_path):
    from fleetgauge.llm import queries

    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(9, text), (10, text)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = {r.doc_id: r for r in queries.op3_decontamination(spark, str(tmp_path)).collect()}
    assert (rows[1].n_words, rows[1].n_hit, rows[1].n_items, rows[1].contaminated) == (13, 13, 2, True)
    assert rows[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest()
    assert (rows[2].n_words, rows[2].contaminated, rows[2].items_sha256) == (0, False, hashlib.sha256(b"").hexdigest())


def test_repeated_rows_cost_in_proportion(docs_of, monkeypatch):
    """Copies of a row, with or without id: each carries its own spans, not those of all copies."""
    text = " ".join(f"word{i} of a longer text" for i in range(60))
    for module, run in ((suffix_repeats, suffix_repeats.remove_repeats), (reference_parse, reference_parse.remove_copied)):
        entries = {}
        for copies in (50, 400):
            seen = []
            with_spans = windows.with_spans
            monkeypatch.setattr(module, "with_spans", lambda docs, cuts, f=with_spans, s=seen: s.append(f(docs, cuts)) or s[0])
            rows = [(None, text)] * copies + [(3, text), (None, text + " and an end of its own")] + [(7, text)] * copies
            out = run(docs_of(rows)).collect()
            assert len(out) == len(rows) and {r.n_removed > 0 for r in out if r.doc_id == 7} == {True}
            entries[copies] = sum(len(r.spans or []) for r in seen[0].select("spans").collect())
            monkeypatch.undo()
        assert entries[400] <= 9 * entries[50]


def plain_labels(text, templates, threshold=0.8, block_words=100):
    """Labels of a text by looking at every block for every template."""
    words = [w.encode() for w in ALNUM.findall(low(text))]
    found, best = set(), 0.0
    for label, notice, *names in templates:
        listed = licences.split(notice)
        length = block_words
        while length < 2 * len(listed):
            length *= 2
        wanted = set(listed)
        for at in range(0, max(1, len(words)), length // 2):
            block = words[at : at + length]
            starts = lambda form, at=at, block=block: any(words[at + i : at + i + len(form)] == form for i in range(len(block)))
            named = all(any(starts(licences.split(form)) for form in name) for name in names)
            share = len(wanted & set(block)) / len(wanted)
            if named and len(wanted & set(block)) >= threshold * len(wanted) - 1e-9:
                found.add(label)
                best = max(best, share)
    return found, best


def test_licenses_by_looking_at_every_block(docs_of):
    """Whole license texts, wrapped, cut, changed and mixed with prose, and short notices among long ones."""
    rng, templates = random.Random(8), licences.TEMPLATES + licences.FULL_TEXTS
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows = []
    for _, notice, *_ in templates:
        words = notice.split()
        rows += [notice, f"{prose(130)} {textwrap.fill(notice, 60)}\n{prose(90)}", " ".join(words[: len(words) * 6 // 10])]
        rows.append(" ".join(w for w in words if rng.random() < 0.85) + " " + prose(40))
        rows.append(" ".join(rng.choice(WORDS) if rng.random() < 0.2 else w for w in words))
        rows.append(prose(30).join(words[i : i + 40] and " ".join(words[i : i + 40]) for i in range(0, len(words), 40)))
    everything = " ".join(t[1] for t in templates).split()
    rows += [" ".join(rng.choice(everything) for _ in range(n)) for n in (50, 150, 400, 900)] + [None, "", prose(5000)]
    docs = docs_of(list(enumerate(rows)))
    got = {r.doc_id: r for r in licences.scan(docs).collect()}
    seen = set()
    for i, text in enumerate(rows):
        labels, share = plain_labels(text, templates)
        assert set(got[i].labels) == labels | set(got[i].base_labels), (i, text and text[:80])
        places = [len(re.findall(f"(?={p})", " ".join(["", *ALNUM.findall(low(text)), ""]))) for p in (f" {p} " for p, _ in licences.PHRASES)]
        assert got[i].n_base == sum(places)
        assert abs(got[i].score - (1.0 if sum(places) else share)) < 1e-9
        seen |= labels
    assert seen == {t[0] for t in templates}

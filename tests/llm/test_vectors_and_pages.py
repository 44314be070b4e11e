"""Near-duplicate vectors and web archives against plain Python."""

from __future__ import annotations

import gzip
import hashlib
import math
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from llm.helpers import CLASHING, as_rows, groups_of
from pyspark.sql import functions as F

from riskmill.llm import embedding_dedup, warc
from riskmill.llm.common import read
from riskmill.sources.workspace import stage

# --- Vectors ------------------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, *[None] * 16) for i, v in rows], f"vec_id long, embedding array<float>, label int, {CLASHING}")


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def plain_links(rows, cosine=0.95):
    good = [(k, np.array(v, np.float32).astype(np.float64)) for k, (_, v) in enumerate(rows) if usable(v)]
    unit = {k: v / np.linalg.norm(v) for k, v in good}
    links, pairs = Counter(), []
    for k, v in unit.items():
        for j, w in unit.items():
            if j < k and len(v) == len(w) and v @ w >= cosine:
                links.update((j, k))
                pairs.append((j, k))
    group = groups_of(range(len(rows)), pairs)
    members = defaultdict(list)
    for k, g in group.items():
        members[g].append(k)
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in members[group[k]] if rows[m][0] is not None]
        component = min(ids, default=None)
        yield i, links[k], component, i == component


COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def clusters(seed, n, dimension, near):
    r = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        center = r.normal(size=dimension)
        for _ in range(near if k % 5 == 0 else 1):
            rows.append((center + r.normal(size=dimension) * 0.12).astype(np.float32).tolist())
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [40, 2048])
def test_links_of_clusters(spark, block):
    rows = clusters(1, 60, 16, 25)
    got = as_rows(embedding_dedup.embedding_duplicates(vectors(spark, rows).repartition(3), block=block), *COLUMNS)
    assert got == sorted(plain_links(rows), key=repr) and max(r[1] for r in got) > 10


def test_links_of_the_table(spark, sf_dir):
    table = read(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert as_rows(embedding_dedup.embedding_duplicates(table, block=100), *COLUMNS) == sorted(plain_links(rows), key=repr)


def test_links_of_awkward_vectors(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 3.0, 4.0]), (5, [float("nan")] * 4), (6, [float("inf"), 1.0, 1.0, 1.0]),
        (7, one), (7, one), (8, one), (9, [2.0, 4.0, 6.0, 8.0]), (10, [-1.0, -2.0, -3.0, -4.0]), (None, one), (None, [5.0, 0.0, 0.0, 0.0]),
        (11, [1.0, 2.0, 3.0]), (12, [1.0, 2.0, 3.1]), (13, [1e30, 2e30, 3e30, 4e30]), (14, [1e-30, 2e-30, 3e-30, 4e-30]), (15, [7.0]), (16, [9.0]),
    ]
    rows += [(100 + k, one) for k in range(50)]
    got = as_rows(embedding_dedup.embedding_duplicates(vectors(spark, rows).repartition(3)), *COLUMNS)
    assert got == sorted(((i, n, c, k if i is not None else c is None) for i, n, c, k in plain_links(rows)), key=repr)


def test_no_usable_vector(spark):
    got = as_rows(embedding_dedup.embedding_duplicates(vectors(spark, [(1, None), (2, [0.0])])), *COLUMNS)
    assert got == [(1, 0, 1, True), (2, 0, 2, True)]
    assert embedding_dedup.embedding_duplicates(vectors(spark, [])).count() == 0


def test_traversal_prunes_and_misses_nothing():
    rows = np.array([v for _, v in clusters(3, 200, 8, 9)])
    unit = embedding_dedup.unit(rows)
    tree = embedding_dedup.cover_tree(unit)
    pairs = embedding_dedup.linked(unit, unit, tree, tree, 0.95)
    found = {(int(i), int(j)) for a, b in pairs for i, j in zip(a, b)}
    i, j = np.nonzero(unit @ unit.T >= 0.95)
    assert found == set(zip(i.tolist(), j.tolist()))
    cells = embedding_dedup.Cells(unit, 40)
    cell, distance = cells.nearest(unit)
    radius = {int(c): float(distance[cell == c].max()) for c in set(cell.tolist())}
    kept = set(cells.pairs(radius, math.sqrt(0.1)))
    assert {tuple(sorted((int(cell[a]), int(cell[b])))) for a, b in zip(i, j)} <= kept
    assert len(kept) < 40 * 41 / 2


@pytest.mark.parametrize("kind", ["float", "double"])
def test_pairs_of_blocks_meet_without_a_shuffle(spark, monkeypatch, kind):
    """Each vector is stored once, however many blocks it is compared with: of spread vectors, all of them."""
    tables, plans = {}, {}

    def staged(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        tables[name] = stage(df, name)
        return tables[name]

    monkeypatch.setattr(embedding_dedup, "stage", staged)
    r = np.random.default_rng(7)
    spread = r.normal(size=(240, 40))
    near = spread[r.integers(0, 40, 120)] + r.normal(size=(120, 40)) * 0.1
    rows = list(enumerate(np.concatenate([spread, near, spread[:30]]).astype(np.float32).tolist()))
    table = vectors(spark, rows).repartition(3).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    got = as_rows(embedding_dedup.embedding_duplicates(table, block=10), *COLUMNS)
    assert got == sorted(plain_links(rows), key=repr) and max(x[1] for x in got) > 3
    assert "Exchange" not in plans["vector-links"]
    assert tables["vector-chunks"].count() > 10
    assert tables["vector-chunks"].selectExpr("sum(size(h1))", "sum(length(vectors))").first()[:] == (360, 360 * 40 * (4 if kind == "float" else 8))


def test_equal_vectors_share_a_cell():
    cells = embedding_dedup.Cells(np.concatenate([np.eye(24), -np.eye(24)]), 48)
    r = np.random.default_rng(8)
    few = embedding_dedup.unit(np.concatenate([np.ones((1, 24)), np.sign(r.normal(size=(40, 24)))]))
    alone = [int(cells.nearest(v[None])[0][0]) for v in few]
    for n in (41, 57, 2048, 3000):
        pick = r.integers(0, 41, n)
        assert cells.nearest(few[pick])[0].tolist() == [alone[k] for k in pick]


# --- Web archives -------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, *[None] * 16) for i, u, h in rows], f"page_id long, url string, html string, {CLASHING}")


def plain_pages(rows):
    first = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None and len(h.encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    for i, _, h in rows:
        data = (h or "").encode()
        refers = first.get(h or "") if i != first.get(h or "") else None
        yield i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers


PAGE_COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_pages_of_the_table(spark, sf_dir):
    table = read(spark, sf_dir, "pages")
    rows = [(r.page_id, r.url, r.html) for r in table.collect()]
    assert as_rows(warc.archive_pages(table), *PAGE_COLUMNS) == sorted(plain_pages(rows), key=repr)


def awkward_pages():
    record = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    copy = "<p>copy é</p>" * 20
    return [
        (1, "http://a", None), (2, None, ""), (3, "http://b/\r\nX: y z", "short"), (4, "u", "short"), (9, "u", copy), (5, "u", copy), (5, "u", copy), (7, "v", copy),
        (10, "u", record * 40), (11, "u", "x" * 32_600 + record * 3), (12, "u", ("é" * 70_000) + "\r\n" * 3), (13, "u", "WARC/1.1\r\n" * 30_000),
        (13, "u", "WARC/1.1\r\n" * 30_000), (14, "u", "z" * 250_000), (None, "u", "only without id " * 20), (None, "u", "only without id " * 20), (None, "u", copy),
        (15, "u", "0\r\n\r\n" * 50), (16, "u", "\n\r\n\r\n\r\nWARC/1.1\r\n\r\n" * 9),
        (17, "http://a/WARC/1.1", "WARC/1.1"), (18, "WARC/1.1", "x" * 8184 + "WARC/1.1"),
    ] + [(100 + i, "u", copy) for i in range(60)]


@pytest.mark.parametrize(("segment", "compression", "split"), [(32_768, "gzip", "128m"), (1000, "none", "5k"), (7, "none", "1m")])
def test_awkward_pages(spark, tmp_path, segment, compression, split):
    rows = awkward_pages() if segment > 7 else [r for r in awkward_pages() if len(r[2] or "") < 4000]
    folder = str(tmp_path / "warc")
    warc.write_warc(pages(spark, rows).repartition(3), folder, segment, compression)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = as_rows(warc.read_warc(spark, folder), *PAGE_COLUMNS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(plain_pages(rows), key=repr)


def test_files_are_plain_archives(spark, tmp_path):
    """A sequential reader that knows only lengths finds the same records."""
    folder = str(tmp_path / "warc")
    warc.write_warc(pages(spark, awkward_pages()).coalesce(1), folder, 1000)
    kinds = Counter()
    for file in Path(folder).glob("part-*"):
        data, at = gzip.decompress(file.read_bytes()), 0
        while at < len(data):
            head = data.index(b"\r\n\r\n", at)
            fields, _ = warc.parse_record(data[at : head + 4] + b"x" * int(data[at:head].split(b"Content-Length: ")[1].split(b"\r\n")[0]))
            assert data.startswith(b"WARC/1.1\r\n", at)
            kinds[fields["warc-type"]] += 1
            at = head + 4 + int(fields["content-length"])
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4
    assert kinds["response"] + kinds["revisit"] == len(awkward_pages()) and kinds["continuation"] > 100


def test_incomplete_segments_fail(spark, tmp_path):
    folder = str(tmp_path / "warc")
    warc.write_warc(pages(spark, [(1, "u", "a" * 5000)]), folder, 1000)
    records = warc.read_records(spark, folder)
    with pytest.raises(Exception, match="not complete"):
        warc.reassembled(records.filter("number IS NULL OR number != 3")).collect()
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_chunks():
    version = b"WARC/1.1\r\n"
    for size in (1, 2, 3, 8, 9, 10, 11, 12, 13, 8192):
        for payload in (b"", b"abc", b"\r\n" + version * 5, version[:-2], b"x" * 8184 + version, version * 2000, bytes(range(256)) * 9):
            framed = warc.chunked(payload, size)
            assert warc.dechunked(framed) == payload and version not in framed
            assert b"".join(warc.segments(framed, size)) == framed
            for part in warc.segments(framed, size):
                assert version not in b"\r\n\r\n" + part + b"\r\n\r\n"
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError, match="chunk"):
        warc.dechunked(b"2\r\nabc\r\n0\r\n\r\n")
    assert warc.target_uri("http://a/WARC/1.1") == "http://a/%57ARC/1.1"
    assert warc.target_uri("http://a/WARC/1.1/b") == "http://a/WARC/1.1/b"


@pytest.mark.parametrize("edge", [4096, 65_536, 131_072])
@pytest.mark.parametrize("packed", [False, True])
def test_a_version_line_at_the_edge_of_a_buffer(spark, tmp_path, edge, packed):
    """Files of two records whose second begins at every offset around the edge, for the file and for a split."""
    head, offsets = warc.records_of(1, "u", b"", "0" * 64, None)[0] + b"\r\n", range(-24, 25)
    for offset in offsets:
        fields = [("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:uuid:x>"), ("X-Pad", "p" * 9)]
        size = edge + offset - len(warc._record(fields, b"y" * 1000)) + 1000 - 2
        first = warc._record(fields, b"y" * size) + b"\r\n"
        first = first.replace(b"p" * 9, b"p" * (9 + edge + offset - len(first)))
        assert len(first) == edge + offset
        data = first + head
        name = f"{offset + 100}.txt" + (".gz" if packed else "")
        (tmp_path / name).write_bytes(gzip.compress(data) if packed else data)
    for split in ("128m", str(edge)):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            kinds = Counter(r["type"] for r in warc.read_records(spark, str(tmp_path)).select("type").collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert kinds == {"resource": len(offsets), "response": len(offsets)}


def test_records_past_many_buffers(spark, tmp_path):
    """60,000 pages of awkward lengths in one unsplit and one split form."""
    table = spark.range(60_000).selectExpr(
        "id AS page_id", "concat('http://h/', id) AS url",
        "concat(id, repeat('WARC/1.1\\r\\n', CAST(id % 7 AS INT)), repeat('a', CAST(id * 37 % 900 AS INT)), repeat('\\r\\n', CAST(id % 5 AS INT))) AS html",
    )
    for compression in ("gzip", "none"):
        folder = str(tmp_path / compression)
        warc.write_warc(table, folder, compression=compression)
        got = warc.read_warc(spark, folder).selectExpr("page_id", "payload_digest", "payload_bytes")
        want = table.selectExpr("page_id", "sha2(html, 256) AS payload_digest", "octet_length(html) AS payload_bytes")
        assert got.exceptAll(want.selectExpr("page_id", "payload_digest", "CAST(payload_bytes AS BIGINT)")).isEmpty()
        assert got.count() == 60_000

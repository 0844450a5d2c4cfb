"""Operators 11 to 13 against brute force, on the given tables and on odd rows."""

from __future__ import annotations

import hashlib
import math
import pathlib
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import nearest, queries, schema_rewrite, vector_codes

SF = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ROW = "vec_id long, embedding array<float>, label int, id long, cell string, vector string"


def plain_nearest(rows, k=20):
    """All pairs, in double precision; rows: (id, vector) that take part, distinct."""
    out = {}
    for q, x in rows:
        if q is None or q % 20:
            continue
        found = [(-float((np.array(x, np.float64) * np.array(y, np.float64)).sum()), math.inf if c is None else c) for c, y in rows if c != q and len(y) == len(x)]
        out.setdefault(q, []).append(sorted(found)[:k])
    return out


def lists_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_op11_equals_all_pairs(spark):
    want = plain_nearest([(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()])
    got = lists_of(QUERIES["op11_nearest"](spark, SF))
    assert got.keys() == want.keys()
    for q, found in got.items():
        assert [(i, c) for i, c, _ in found] == [(i, c) for i, (_, c) in enumerate(want[q][0], 1)]
        assert np.allclose([s for *_, s in found], [-s for s, _ in want[q][0]], rtol=1e-12, atol=0)


@pytest.mark.parametrize("small", [False, True])
def test_nearest_on_odd_rows(spark, monkeypatch, small):
    """Ties, copies, repeated rows and ids, null ids, other lengths, vectors that take no part; with tiny tiles, blocks and stripes the same."""
    if small:
        monkeypatch.setattr(nearest, "TILE", 7)
        monkeypatch.setattr(nearest, "BLOCK_BYTES", 64)
        monkeypatch.setattr(nearest, "STRIPE_ROWS", 40)
    rng = np.random.default_rng(3)
    common = [1.0, 0.0, 0.0, 0.0]
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 4)]) for i in range(120)] + [(i, common) for i in range(120, 200)]
    rows += [(None, common), (None, common), (40, common), (60, [1e38, -1e38, 3e38, 1.0]), (61, [1e-40, 0.0, 0.0, 1e-42]), (80, [1.0, 2.0]), (82, [3.0, 1.0])]
    none = [(100, None), (101, []), (102, [0.0] * 4), (103, [1.0, None, 0.0, 0.0]), (104, [float("nan")] * 4), (105, [float("inf"), 0.0, 0.0, 0.0])]
    data = [(i, v, 0, 7, "x", "y") for i, v in rows + none + rows[:30]]
    as_float = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    part = list(dict.fromkeys((i, tuple(v)) for i, v in as_float if any(v)))
    want = plain_nearest(part, 5)
    got = {}
    for r in nearest.nearest(spark.createDataFrame(data, ROW), F.col("id") % 20 == 0, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], -r["score"], math.inf if r["vec_id"] is None else r["vec_id"]))
    flat = {q: sorted((i, s, c) for found in lists for i, (s, c) in enumerate(found, 1)) for q, lists in want.items()}
    assert {q: sorted(v) for q, v in got.items()} == {q: v for q, v in flat.items() if v}


def test_nearest_of_nothing_and_of_one(spark):
    assert nearest.nearest(spark.createDataFrame([], ROW), F.col("id") % 20 == 0).collect() == []
    assert nearest.nearest(spark.createDataFrame([(0, [1.0], 1, 1, "", "")], ROW), F.col("id") % 20 == 0).collect() == []


def test_tile_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 33)) * 10.0 ** rng.integers(-8, 8, (50, 1)), rng.standard_t(2, size=(70, 33))
    near, off = nearest.tile(nearest.Codes(x), nearest.Codes(y), slice(0, 50))
    assert (np.abs(x @ y.T - near) <= off).all()
    assert (off < 0.02 * np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)).all()


def plain_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    """rows: (id, vector), sorted as the first entries are drawn."""
    x = [[[math.floor(v * scale) for v in vec[p * len(vec) // parts : (p + 1) * len(vec) // parts]] for p in range(parts)] for _, vec in rows]
    books = [[x[i][p] for i in range(min(entries, len(x)))] for p in range(parts)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            groups = {}
            for row in x:
                groups.setdefault(assign(row[p], p)[1], []).append(row[p])
            for i, g in groups.items():
                new[p][i] = [sum(c) // len(g) for c in zip(*g, strict=True)]
        books = new
    best = [[assign(row[p], p) for p in range(parts)] for row in x]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return {i: ("".join(f"{e:02x}" for _, e in b), sum(d for d, _ in b)) for (i, _), b in zip(rows, best, strict=True)}, sha


def test_op13_equals_plain_python(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    want, sha = plain_codes([(r["vec_id"], r["embedding"]) for r in rows])
    labels = {}
    for r in rows:
        labels[r["label"]] = labels.get(r["label"], 0) + want[r["vec_id"]][1]
    label = {r["vec_id"]: r["label"] for r in rows}
    got = QUERIES["op13_vector_codes"](spark, SF)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = got.collect()
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want and len(got) == len(rows)
    assert all(r["codebooks_sha256"] == sha and r["label_error"] == labels[label[r["vec_id"]]] for r in got)


def test_codes_of_odd_rows(spark, monkeypatch):
    """Ties, repeated rows, null ids and labels, other lengths, vectors that go, fewer rows than entries; with and without a broadcast."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) / 256 for v in rng.integers(-4, 4, 32)], i % 3 or None) for i in range(40)] + [(None, [0.5] * 32, 1)] + [(3, [0.25] * 32, None)] * 2
    other = [(90, [1.0, 2.0], 2), (91, [1.0] * 16, None)]
    gone = [(92, None, 1), (93, [], 1), (94, [None] * 32, 1), (95, [float("nan")] * 32, 1), (96, [float("-inf")] * 32, 1)]
    df = spark.createDataFrame([(i, v, k, 1, "", "") for i, v, k in rows + other + gone], ROW)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want, sha = plain_codes([((i, tuple(v), k), v) for i, v, k in order], rounds=2)
    totals = {}
    for _, v, k in rows:
        key = next(x for x in want if x[1] == tuple(v))
        totals[k] = totals.get(k, 0) + want[key][1]
    for most in (vector_codes.BROADCAST_LABELS, 0):
        monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", most)
        got = vector_codes.compress(df).collect()
        assert len(got) == len(rows) + 2
        assert sorted((r["code"], r["error"]) for r in got if r["code"]) == sorted(want[(i, tuple(v), k)] for i, v, k in rows)
        assert {(r["label"], r["label_error"]) for r in got} == {*totals.items()}
        assert {r["id"] for r in got if r["code"] is None} == {90, 91} and {r["codebooks_sha256"] for r in got} == {sha}
    assert vector_codes.compress(spark.createDataFrame([], ROW)).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0, 2.0], 1, 1, "", "")], ROW))


@pytest.mark.parametrize("length", [1, 2, 3, 8, 20])
def test_entry_bounds_lose_no_winner(length):
    rng = np.random.default_rng(length)
    books = vector_codes.Codebooks(rng.integers(-300, 300, (3, 64, length)))
    x = rng.integers(-300, 300, (400, 3, length))
    x[:64, :] = books.entries.transpose(1, 0, 2)[:64]
    code, distance = books.assign(x)
    every = ((x[:, :, None] - books.entries) ** 2).sum(3)
    assert (code == every.argmin(2)).all() and (distance == every.min(2)).all()
    for s in books.levels:
        low = ((vector_codes.segment_features(x, s)[:, :, None] - vector_codes.segment_features(books.entries, s)) ** 2).sum(3)
        assert (low * (1 - 1e-9) - 1e-3 <= every).all()


NAMES = [f.name for f in schema_rewrite.CLIENTS]


def plain_rewrite(rows):
    """rows: dicts in any order; the digests of the final files."""
    rows = sorted(rows, key=lambda r: (zlib.crc32(str(r["client_id"]).encode()), r["client_id"]))
    size, out = 1 + len(rows) // 500, {}
    for at in range(0, len(rows), size):
        no = at // size
        v = zlib.crc32(f"42:{no}".encode()) % 24
        v = v if v < 16 else 0
        lines, nulls = [], 0
        for r in rows[at : at + size]:
            r = dict(r)
            if v & 4:
                r["nation_id"], r["source"] = -1, "none"
            if v & 8 and r["balance"] is not None:
                r["balance"] = float(np.float32(r["balance"]))
            nulls += sum(x is None for x in r.values())
            stamp = r["updated_at"]
            if stamp is not None:
                r["updated_at"] = (np.datetime64(stamp) - np.datetime64("1970-01-01")) // np.timedelta64(1, "us")
            if r["balance"] is not None:
                r["balance"] = math.floor(1048576 * r["balance"])
            lines.append("|".join("?" if r[c] is None else str(r[c]) for c in NAMES))
        out[no] = (v, len(lines), nulls, hashlib.sha256(",".join(str(r["client_id"]) for r in rows[at : at + size]).encode()).hexdigest(), hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def start_names(v):
    names = list(NAMES)
    if v & 1:
        names[4], names[5] = "email", "name"
    if v & 2:
        names[1:] = names[:0:-1]
    return [c for c in names if not (v & 4 and c in ("nation_id", "source"))]


def local(path):
    return path.removeprefix("file://")


def checked_files(got):
    """The final folder as the result says, every file under the evolved schema."""
    folder = pathlib.Path(local(got[0]["path"])).parent
    assert {str(p) for p in folder.rglob("*") if p.is_file()} == {local(r["path"]) for r in got}
    assert not (folder.parent / "work").exists()
    for r in got:
        f = pq.ParquetFile(local(r["path"]))
        assert f.schema_arrow.names == NAMES and f.metadata.num_rows == r["n_rows"]
        assert [int(x.metadata[b"PARQUET:field_id"]) for x in f.schema_arrow] == list(range(1, 11))
        assert str(f.schema_arrow.field("nation_id").type) == "int64" and str(f.schema_arrow.field("balance").type) == "double"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op12_equals_plain_python(spark, sf):
    rows = [r.asDict() for r in spark.read.parquet(f"/root/testdata/{sf}/clients.parquet").select(*NAMES).collect()]
    want = plain_rewrite(rows)
    got = QUERIES["op12_schema_rewrite"](spark, f"/root/testdata/{sf}").collect()
    assert {r["file_no"]: (r["version"], r["n_rows"], r["n_nulls"], r["ids_sha256"], r["rows_sha256"]) for r in got} == want
    for r in got:
        assert r["start_columns"].split(",") == start_names(r["version"]) and r["columns"].split(",") == NAMES
        assert r["rewritten"] == (r["version"] != 0)
    checked_files(got)


def test_rewrite_starts_from_drifted_files_and_can_run_again(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/clients.parquet").select(*NAMES)
    ranked, total = schema_rewrite.exact_ranks(df, "client_id")
    folder = f"file://{tmp_path}/f"
    parts = ranked, folder, schema_rewrite.CLIENTS, 20, lambda no: no % 16, schema_rewrite.drifted_clients
    started = schema_rewrite.write_files(*parts).cache()
    for r in started.collect():
        f = pq.ParquetFile(local(r["path"])).schema_arrow
        ids = {name: i for i, name in enumerate(NAMES, 1)}
        if r["version"] & 1:
            ids["name"], ids["email"] = 6, 5
        assert f.names == start_names(r["version"]) and all(int(f.field(c).metadata[b"PARQUET:field_id"]) == ids[c] for c in f.names)
        assert str(f.field("balance").type) == ("float" if r["version"] & 8 else "double")
        if not r["version"] & 4:
            assert str(f.field("nation_id").type) == ("int32" if r["version"] & 8 else "int64")
    before = {r["path"]: pathlib.Path(local(r["path"])).stat().st_mtime_ns for r in started.collect() if not r["version"]}
    (tmp_path / "f/work").mkdir(exist_ok=True)
    (tmp_path / "f/work/left-by-a-lost-task.parquet").write_bytes(b"half")
    first = sorted(schema_rewrite.evolve_files(started, folder, schema_rewrite.CLIENTS, schema_rewrite.FILL).collect())
    again = schema_rewrite.evolve_files(started, folder, schema_rewrite.CLIENTS, schema_rewrite.FILL).cache()
    assert sorted(again.collect()) == first and len(first) == -(-total // 20)
    for _ in range(2):
        schema_rewrite.delete_replaced(started, again, folder)
    checked_files(again.collect())
    assert before == {p: pathlib.Path(local(p)).stat().st_mtime_ns for p in before}


def client(i, k, **other):
    return {"client_id": i, "master_id": k, "source": None, "updated_at": None, "name": f"n{k}", "email": None, "city": "", "nation_id": 1, "segment": "s", "balance": 1.5} | other


def client_frame(spark, rows):
    kinds = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, segment string, balance double, _rank string, file_no int"
    return spark.createDataFrame([(*r.values(), "x", 5) for r in rows], kinds)


def test_ranks_with_hot_ids(spark, monkeypatch):
    """A third of the rows under one id, a sixth equal in all columns: ranks have no gap, follow crc32 and id, and equal those without splits."""
    rows = [client(i, i) for i in range(900)] + [client(7, k) for k in range(1000)] + [client(11, 0)] * 500 + [client(None, 3), client(None, 4)]
    df = client_frame(spark, rows).repartition(9)

    def placed(bits):
        ranked, total = schema_rewrite.exact_ranks(df, "client_id", bits)
        out = sorted((r["_rank"], r["client_id"], r["master_id"]) for r in ranked.select(F.col("_rank").cast("string").cast("long").alias("_rank"), "client_id", "master_id").collect())
        assert [r[0] for r in out] == list(range(total)) and total == len(rows)
        return out

    df = df.drop("_rank", "file_no")
    plain = placed(16)
    monkeypatch.setattr(schema_rewrite, "HEAVY_LEAST", 40)
    assert placed(4) == plain
    crc = [0 if i is None else zlib.crc32(str(i).encode()) for _, i, _ in plain]
    assert crc == sorted(crc) and plain[0][1] is None


def test_rewrite_of_odd_rows(spark):
    rows = [client(i, i) for i in range(30)] + [client(5, 5)] * 3 + [client(None, 1, balance=float("nan")), client(40, 2, balance=1e300), client(41, 3, name="é|\n", balance=None)]
    got = schema_rewrite.rewrite_clients(client_frame(spark, rows), files=4).collect()
    checked_files(got)
    assert sum(r["n_rows"] for r in got) == len(rows) and [r["file_no"] for r in sorted(got)] == list(range(len(got)))
    assert schema_rewrite.rewrite_clients(client_frame(spark, rows).limit(0)).collect() == []

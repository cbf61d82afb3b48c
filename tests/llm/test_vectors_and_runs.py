"""Vector codes, exact top-k search and periodic runs: operators and registered queries against plain Python."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airlend.llm import exact_search, periodic_runs, product_codes, queries
from airlend.llm.sql import SQL
from airlend.llm.vectors import whole

VECTORS = "vec_id long, embedding array<double>, label int, id string, v int, code string, error double"


def awkward_vectors(n: int, length: int) -> list[tuple]:
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((6, length))
    rows = [(int(k * 5), (centres[k % 6] + 0.4 * rng.standard_normal(length)).round(3).tolist(), k % 5) for k in range(n)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [nan] * length, [None, *[0.5] * (length - 1)], [inf, *[0.0] * (length - 1)], [-inf] * length, [], [1.0]]
    rows += [(50 * k, v, None) for k, v in enumerate(bad)]
    rows += [(3, [0.0] * length, None), (4, rows[0][1], 0), (4, rows[0][1], 0), (4, rows[1][1], None), rows[20]]
    rows += [(None, rows[2][1], 1), (None, None, None), (250, rows[40][1], 2)]
    rows += [(10_001 + k, rows[50][1], 9) for k in range(n // 2)]  # a third of all rows
    return [(*row, "x", 7, "c", 0.5) for row in rows]


def fixture_folder(spark, folder, name, rows, schema, parts=4) -> str:
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def codes_by_rule(rows, parts=8, entries=16, rounds=6):
    """Code and error of each kept row, in the order of ids and vectors, and the codebooks."""
    kept = [r for r in rows if r[1] and len(r[1]) > 1 and all(x is not None and np.isfinite(x) for x in r[1])]
    points = [tuple(int(np.floor(4096 * x)) for x in r[1]) for r in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, points[k]))
    kept, x = [kept[k] for k in order], np.array([points[k] for k in order])
    width = x.shape[1] // parts
    codes, errors, books = [], 0, []
    for p in range(parts):
        part = x[:, p * width : (p + 1) * width]
        book = part[:entries].copy()
        for turn in range(rounds + 1):
            distance = ((part[:, None] - book[None]) ** 2).sum(axis=2)
            nearest = distance.argmin(axis=1)
            if turn < rounds:
                for e in set(nearest.tolist()):
                    book[e] = part[nearest == e].sum(axis=0) // (nearest == e).sum()
        codes.append(nearest)
        errors = errors + distance.min(axis=1)
        books.append(book)
    return kept, ["".join(f"{c[k]:02x}" for c in codes) for k in range(len(kept))], errors.tolist(), books


def test_orchard_search_finds_the_nearest():
    rng = np.random.default_rng(1)
    for n, width, spread in [(1, 1, 5), (2, 3, 2), (16, 2, 3), (16, 8, 4000), (40, 4, 6)]:
        entries, points = rng.integers(-spread, spread, (n, width)), rng.integers(-spread, spread, (500, width))
        entries[n // 2] = entries[0]
        distance = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        best, least, compared = product_codes.Codebook(entries).nearest(points)
        assert (best == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()
        assert compared <= len(points) * n
    centres = rng.integers(-4000, 4000, (16, 8))  # clear clusters: few entries are compared
    points = centres[rng.integers(0, 16, 2000)] + rng.integers(-50, 50, (2000, 8))
    assert product_codes.Codebook(centres).nearest(points)[2] < 0.7 * 2000 * 16


def test_vector_codes_query(spark, tmp_path):
    rows = awkward_vectors(300, 24)
    folder = fixture_folder(spark, tmp_path, "embeddings", rows, VECTORS)
    kept, codes, errors, books = codes_by_rule(rows)
    total = {}
    for row, error in zip(kept, errors):
        total[row[2]] = total.get(row[2], 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
    want = [(row[0], c, e, total[row[2]], digest) for row, c, e in zip(kept, codes, errors)]
    found = [tuple(r) for r in queries.op11_vector_codes(spark, folder).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_vector_codes_decode_and_small_tables(spark):
    frame = spark.createDataFrame([(1, [0.25, -1.0, 2.0]), (2, [0.5, 1.0, 3.0]), (None, None)], "id long, x array<double>")
    rows = frame.select("id", whole(F.col("x"), 4).alias("v")).where("v IS NOT NULL")
    model = product_codes.ProductCodes.fit(rows, parts=2, entries=5, rounds=2)
    found = model.decode(model.encode(rows)).orderBy("id").collect()
    assert [(r.v, r.error) for r in found] == [([1, -4, 8], 0), ([2, 4, 12], 0)]  # an entry for each row
    model = product_codes.ProductCodes.fit(rows.where("id > 5"))
    assert model.encode(rows.where("id > 5")).columns == ["id", "code", "error"]
    assert model.decode(model.encode(rows)).count() == 0
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([([1e30],)], "x array<double>").select(whole(F.col("x"), 4)).collect()


def test_label_errors_with_many_labels(spark, monkeypatch):
    codes = spark.createDataFrame([(k, k % 3 if k % 7 else None, k) for k in range(200)], "id long, label int, error long")
    want = sorted(product_codes.with_label_error(codes).collect())
    monkeypatch.setattr(product_codes, "BROADCAST_LABELS", 0)
    assert sorted(product_codes.with_label_error(codes).collect()) == want and len(want) == 200


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_exact_top_k"])
def test_vector_sql(spark, tmp_path, name):
    rows = [r for r in awkward_vectors(150, 16) if r[0] is not None and r[1] != [] and r[1] != [1.0]]
    rows = list({r[0]: r for r in rows}.values())
    folder = fixture_folder(spark, tmp_path, "embeddings", rows, VECTORS)
    embeddings = pd.DataFrame({"vec_id": [r[0] for r in rows], "label": pd.array([r[2] for r in rows], "Int64")})
    db = duckdb.connect()
    db.sql(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
    want = db.sql(SQL[name]).df()
    got = getattr(queries, name)(spark, folder).toPandas()[list(want.columns)]
    by = ["vec_id"] if "code" in want else ["query_id", "rank"]
    pd.testing.assert_frame_equal(got.sort_values(by, ignore_index=True), want.sort_values(by, ignore_index=True), check_dtype=False)
    assert len(embeddings) and len(want)


def top_by_rule(rows, length, k=5):
    usable = [r for r in rows if r[0] is not None and r[1] and len(r[1]) == length]
    usable = [r for r in usable if all(x is not None and np.isfinite(x) for x in r[1])]
    ids, x = np.array([r[0] for r in usable]), np.floor(256 * np.array([r[1] for r in usable])).astype(int)
    found = []
    for query in sorted({i for i in ids.tolist() if i % 50 == 0}):
        v = min(x[ids == query].tolist())
        score = x @ np.array(v)
        order = np.lexsort((ids, -score))
        order = order[ids[order] != query][:k]
        found += [(query, n + 1, int(ids[o]), int(score[o])) for n, o in enumerate(order)]
    return found


@pytest.mark.parametrize("small", [False, True])
def test_exact_top_k_query(spark, tmp_path, monkeypatch, small):
    if small:  # several groups, blocks and slots, and hardly any floor to begin with
        for name, value in {"QUERY_BLOCK": 3, "ROW_BLOCK": 40, "GROUP": 2, "SEEDS": 4, "ROWS_AT_ONCE": 16}.items():
            monkeypatch.setattr(exact_search, name, value)
    rows = awkward_vectors(400, 20)
    folder = fixture_folder(spark, tmp_path, "embeddings", rows, VECTORS)
    found = sorted(tuple(r) for r in queries.op12_exact_top_k(spark, folder).collect())
    assert found == top_by_rule(rows, 20)


def test_exact_top_k_of_few_rows(spark):
    rows = spark.createDataFrame([(50, [3]), (50, [2]), (1, [5]), (2, [0]), (3, None), (None, [9])], "id long, v array<int>")
    usable = exact_search.usable(rows)
    found = exact_search.top_k(usable, usable.where("id = 50")).collect()
    assert [tuple(r) for r in found] == [(50, 1, 1, 10), (50, 2, 2, 0)]
    alone = exact_search.usable(rows.where("id = 50"))
    assert exact_search.top_k(alone, alone).count() == 0
    none = exact_search.usable(rows.where("id = 7"))
    assert exact_search.top_k(none, none).count() == 0


def test_bounds_spare_scores():
    rng = np.random.default_rng(5)
    centres = rng.integers(-300, 300, (40, 64))
    rows = centres[rng.integers(0, 40, 4000)] + rng.integers(-30, 30, (4000, 64))
    asked, ids = rows[:100], np.arange(4000)
    *found, computed = exact_search.search_block(ids[:100], asked, np.full(100, exact_search.NO_FLOOR), ids, rows, 5)
    score = asked @ rows.T
    score[np.arange(100), np.arange(100)] = exact_search.NO_FLOOR
    assert (np.array(found[2]).reshape(100, 5) == -np.sort(-score, axis=1)[:, :5]).all()
    assert computed < 0.25 * score.size


def runs_by_rule(words: list) -> list[tuple[int, int, int]]:
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def repeated(rng, alphabet: int, unit: int, times: float) -> list[str]:
    part = [f"w{rng.randrange(alphabet)}" for _ in range(unit)]
    return (part * (int(times) + 1))[: int(unit * times)]


def awkward_texts() -> list[str | None]:
    rng = random.Random(6)
    texts = [None, "", " \t\x0b\n\f\r ", "one", "a " * 5, "a " * 6, "a b " * 12, "a b " * 8, "é\x1fé   " * 9]
    texts += [" ".join(rng.choice("ab") for _ in range(n)) for n in (30, 90, 200, 400) for _ in range(4)]
    for _ in range(40):
        words = []
        for _ in range(rng.randint(1, 6)):
            words += [f"n{rng.randrange(500)}" for _ in range(rng.randint(0, 40))]
            words += repeated(rng, rng.choice([2, 3, 50]), rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 70]), rng.uniform(2, 7))
        texts.append("\n".join(words))
    inner = repeated(rng, 5, 3, 5)
    texts += [" ".join((inner + ["x", "y"]) * 6), " ".join(repeated(rng, 900, 130, 4.0)), " ".join(repeated(rng, 2, 300, 4.5))]
    fib = ["a", "b"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    return texts + [" ".join(fib[-1]), " ".join("ab"[bin(k).count("1") % 2] for k in range(512)), texts[4], "same same"]


def test_find_runs():
    texts = awkward_texts()
    found = [(runs, n) for runs, n, _ in periodic_runs._documents([t if t is None else t.encode() for t in texts])]
    for text, (runs, n) in zip(texts, found):
        words = (text or "").encode().split()
        assert n == len(words) and runs == runs_by_rule(words)
    assert max(length for runs, _ in found for _, length, _ in runs) >= 1000
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.array([0]), np.array([0]), repeats=3)


def test_very_long_periodic_texts():
    for unit, n in [("a", 300_000), ("a b", 200_000), (" ".join(f"x{k}" for k in range(20_000)), 9)]:
        words = len(unit.split()) * n
        ((runs, size, text),) = periodic_runs._documents([" ".join([unit] * n).encode()])
        assert runs == [(0, words, words // n)] and size == words and text.decode() == unit


def test_periodic_runs_query(spark, tmp_path):
    rng = random.Random(16)
    texts = awkward_texts() + [" ".join(f"p{rng.randrange(40)}" for _ in range(rng.randint(0, 300))) for _ in range(120)]
    schema = "doc_id long, text string, runs string, n_words int, a int, h string, words string"
    rows = [(k - 3, text, "r", 1, 2, "h", "w") for k, text in enumerate(texts)] + [(None, "b " * 9, *[None] * 5), (9, "z " * 7, *["1"] * 1, 1, 1, "1", "1")]
    folder = fixture_folder(spark, tmp_path, "documents", rows, schema)
    want = []
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if n and h is not None and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = runs_by_rule(words)
        gone = {i for start, length, q in runs for i in range(start + q, start + length)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * top[1] // top[2] if runs else None
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
        want.append((doc_id, len(runs), *top, milli, digest, hashlib.sha256(rest).hexdigest()))
    found = [tuple(r) for r in queries.op13_periodic_runs(spark, folder).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sum(row[1] > 0 for row in want) > 40


def test_periodic_runs_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a " * 8, "s", 4)], "doc_id long, text string, source string, n_words int")
    found = periodic_runs.collapse_runs(docs)
    assert found.columns == ["doc_id", "text", "source", "runs", "n_words", "collapsed"]
    row = found.first()
    assert (row.n_words, row.collapsed, [tuple(r) for r in row.runs]) == (8, "a", [(0, 8, 1)])
    assert periodic_runs.collapse_runs(docs.where("doc_id > 1")).count() == 0

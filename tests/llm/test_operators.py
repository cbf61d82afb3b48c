"""Every operator against brute force on small awkward tables: nulls, empty and long texts, copies, clashing names."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from airlend.llm import (
    ann,
    bpe,
    language_id,
    line_dedup,
    merkle,
    near_dups,
    packing,
    secret_scan,
    simple8b,
    suffix_dedup,
    token_files,
)
from airlend.llm.sql import SQL

LIBRARY, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row int, n_removed string"


def sentence(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    return " ".join(made)


PASSAGE = sentence(1, 60)
LONG = "\n".join(sentence(100 + k, 30) for k in range(80))
TEXTS = [
    None,
    "",
    "   \n\n ",
    "12 34 !!",
    f"Héllo wörld, don't {PASSAGE}",
    f"{sentence(2, 10)}\n{PASSAGE}\n{sentence(3, 12)}",
    f"{sentence(4, 9)}\n\n{PASSAGE}\n{sentence(5, 12)}",
    LONG,
    LONG + " changed end",
    LONG,
    "ab" * 400,
    "password=abcdef12 token: 'abc' AKIA" + "B7" * 9 + " " + "0f" * 14 + " Zx9-qW3_kLm8PvR2tYb7 日本語",
    "token=token: abcdef API_KEY : \"x.y-z_1\"",
]
ROWS = [(k, t, "en" if k % 2 else "fr", "s", 1, 0.5, k, "x") for k, t in enumerate(TEXTS)]
ROWS += [ROWS[5], (None, PASSAGE, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def ids_by_library(end: int) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(LIBRARY)
    return [e.ids + [end] for e in tokenizer.encode_batch([r[1] or "" for r in ROWS], add_special_tokens=False)]


@pytest.mark.parametrize("high", [2, 40, 50_257, 2**40, 2**64])
def test_simple8b_round_trip(high):
    rng = np.random.default_rng(high % 97)
    for n in (0, 1, 59, 4096, 9001):
        values = rng.integers(0, high, n, dtype=np.uint64, endpoint=False) if high < 2**64 else rng.integers(0, 2**64, n, dtype=np.uint64)
        data = simple8b.encode(values)
        assert (simple8b.decode(data) == values).all()
        for block in range(-(-n // simple8b.BLOCK)):
            part = values[block * simple8b.BLOCK : (block + 1) * simple8b.BLOCK]
            assert (simple8b.decode_block(data, block) == part).all()


def test_token_files(spark, docs, none, tmp_path):
    token_files.write_tokens(docs, f"{tmp_path}/a", LIBRARY)
    found = token_files.read_tokens(spark, f"{tmp_path}/a").orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((r[0] for r in ROWS), key=lambda x: -1 if x is None else x)
    expected = Counter((r[0], zlib.crc32(struct.pack(f"<{len(i)}I", *i))) for r, i in zip(ROWS, ids_by_library(0)))
    assert Counter((r.doc_id, zlib.crc32(r.ids)) for r in found) == expected
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    token_files.write_tokens(none, f"{tmp_path}/b", LIBRARY)
    assert token_files.read_tokens(spark, f"{tmp_path}/b").count() == 0


def test_packing(docs, none):
    rows = packing.best_fit(packing.token_pieces(docs, LIBRARY, capacity=64), capacity=64).toPandas()
    for _, one in rows.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert one.offset.tolist() == [0, *one.length.cumsum().tolist()[:-1]] and one.length.sum() <= 64
    assert rows.length.sum() == sum(map(len, ids_by_library(2)))
    assert rows[rows.piece > 0].length.eq(64).all()
    assert rows.sequence_id.nunique() <= -(-rows.length.sum() // 64) + 1
    assert packing.best_fit(packing.token_pieces(none, LIBRARY)).count() == 0


def test_packing_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(50):
        lengths = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 200))), reverse=True)
        gaps = []
        for n in lengths:
            fit = min((g for g in gaps if g >= n), default=None)
            if fit is not None:
                gaps.remove(fit)
            gaps.append((30 if fit is None else fit) - n)
        runs = packing.place_runs(Counter(lengths), 30)
        assert len({s for _, _, n, first, _ in runs for s in range(first, first + n)}) == len(gaps)


def test_bpe(docs, none):
    ranks = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    got = Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in found)
    assert got == Counter((r[0], tuple(library.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in ROWS)
    assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_suffix_dedup(docs, none):
    texts = {(r[0], r[1] or "") for r in ROWS}
    seen = Counter(t.encode()[k : k + 200] for _, t in texts for k in range(len(t.encode()) - 199))
    expected = {}
    for doc_id, text in texts:
        data, end, gone = text.encode(), 0, []
        for k in range(len(data)):
            if len(data) - k >= 200 and seen[data[k : k + 200]] > 1:
                end = k + 200
            gone.append(k < end)
        spans = sum(g and not b for g, b in zip(gone, [False, *gone]))
        expected[doc_id, len(data)] = (sum(gone), spans, bytes(x for x, g in zip(data, gone) if not g))
    found = suffix_dedup.remove_repeats(docs).collect()
    assert len(found) == len(ROWS)
    for r in found:
        assert (r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.doc_id, r.n_bytes]
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_language_id(spark, docs, none):
    stops = {"en": "the of and to in", "de": "der die und das ist", "fr": "le la les des est"}
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice(stops[lang].split()) for _ in range(20)), lang) for k in range(90) for lang in stops]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [("the andes of", "en"), ("und derdas istig", "de"), ("les leste", "fr"), (None, "und"), ("12 ²", "und"), ("", "und")]
    frame = spark.createDataFrame([(t, "x", w) for t, w in tests], "text string, score string, want string")
    found = language_id.predict(frame, model).collect()
    assert [r.lang_pred for r in found] == [w for _, w in tests]
    assert all(0 <= r.score <= 1 for r in found) and found[3].score == 0
    assert {r.lang_pred for r in language_id.predict(docs, language_id.train(none)).collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0


def test_language_id_keeps_all_counts(spark):
    """A language whose words are all rare is told whatever is sent to the executors."""
    rng = random.Random(9)
    words = {lang: ["".join(rng.choice("aeioulnrst") for _ in range(6)) for _ in range(40)] for lang in ("aa", "bb", "cc")}
    made = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(15))
    rows = [(made(lang), lang) for lang, n in (("aa", 60), ("bb", 60), ("cc", 6)) for _ in range(n)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    texts = [(k, made(lang) + (" eiou~ntsr" if k % 2 else ""), lang) for k, lang in enumerate(list(words) * 6)]
    frame = spark.createDataFrame([*texts, texts[3]], "k int, text string, want string")
    told = []
    for bounds in ((50_000, 100_000), (40, 100), (0, 0)):
        found = language_id.predict(frame, language_id.train(labelled, *bounds)).orderBy("k").collect()
        assert len(found) == len(texts) + 1 and all(r.lang_pred == r.want for r in found)
        told.append([r.score for r in found])
    assert np.allclose(told[0], told[1], rtol=1e-9) and np.allclose(told[0], told[2], rtol=1e-9)


def test_secret_scan(docs, none):
    assign = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    ratios = secret_scan.train(secret_scan.labelled_samples(docs))
    found = secret_scan.find(docs, ratios)
    rows = found.select("doc_id", "text", secret_scan.written(F.col("base")).alias("b"), secret_scan.written(F.col("spans")).alias("s"))
    for r in rows.collect():
        text = r.text or ""
        spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert r.b == ",".join(f"{k}:{a}:{e}" for a, _, e, k in sorted(spans))
        assert set(r.b.split(",")) <= set(r.s.split(",")) or not r.b
    text = TEXTS[11]
    at = text.index("Zx9")
    assert f"markov:{at}:{at + 20}" in {r.doc_id: r.s for r in rows.collect()}[11]
    clean = {r.doc_id: r.text for r in secret_scan.redact(found).collect()}
    assert "Zx9" not in clean[11] and "abcdef12" not in clean[11] and clean[7] == LONG and clean[0] is None
    assert secret_scan.find(none, secret_scan.train(secret_scan.labelled_samples(none))).count() == 0


def test_secret_scan_of_ordinary_identifiers(spark, docs):
    """Neither the identifiers nor the keys were met in training."""
    ordinary = """src/main/java/com/example docs/2023/10/index 2024-01-15T10-30-00Z getUserAccountBalance
        MAX_CONNECTION_POOL_SIZE user_id_2023_backup_v2 linux-x86_64-3-11-2 AbstractBeanFactoryImpl
        invoice-2021-12-31-draft node_modules/lodash/package /usr/share/doc/openssl deploy_worker_pods_by_zone
        opt/releases/2019/07/archive HttpServletResponse KUBERNETES_SERVICE_HOST v2-14-1_stable_release""".split()
    rng = random.Random(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    kinds = [letters, letters + "+/", letters + "-_", letters[:26] + letters[-10:], "0123456789abcdef"]
    keys = ["".join(rng.choice(kinds[k % 5]) for _ in range(20 + k % 3)) for k in range(300)]
    texts = [(k, f"see {t} there") for k, t in enumerate(ordinary + keys)]
    ratios = secret_scan.train(secret_scan.labelled_samples(docs))
    clean = secret_scan.redact(secret_scan.find(spark.createDataFrame(texts, "doc_id long, text string"), ratios))
    masked = {r.doc_id for r in clean.collect() if "[SECRET]" in r.text}
    assert [t for k, t in enumerate(ordinary) if k in masked] == []
    assert len([k for k in masked if k >= len(ordinary)]) >= 0.98 * len(keys)


def test_secret_scan_of_a_text_with_very_many_candidates(spark, docs):
    """Also tokens that overlap base spans at either end or at both, and one very long token."""
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n=20: "".join(rng.choice(letters) for _ in range(n))
    cut = [f"{key()}password={key()}", f"{key()}{'ab12' * 8}", f"{'ab12' * 8}{key()}", f"{key()}{'0f3e' * 8}{key()}"]
    long = " ".join([f"{key()} word" for _ in range(700)] + cut + [key(5_000)])
    texts = [(0, long), (1, " ".join(cut)), (2, f"{key()}\n{key()} token: {key()}\U0001F600 {key()}")]
    ratios = secret_scan.train(secret_scan.labelled_samples(docs))
    found = secret_scan.find(spark.createDataFrame(texts, "doc_id long, text string"), ratios)
    rows = {r.doc_id: r for r in found.collect()}
    clean = {r.doc_id: r.text for r in secret_scan.redact(found).collect()}
    for doc, text in texts:
        base = [(x.start, x.end) for x in rows[doc].base]
        tokens = [(m.start(), m.end()) for m in re.finditer("[A-Za-z0-9+/_-]{16,}", text)]
        free = {t for t in tokens if not any(a < t[1] and t[0] < b for a, b in base)}
        spans = [(x.start, x.end) for x in rows[doc].spans]
        assert set(spans) - set(base) <= free and len(spans) >= len(base) + 0.95 * len(free)
        out, at = "", 0
        for a, b in spans:
            if a >= at:
                out += text[at:a] + "[SECRET]"
            at = max(at, b)
        assert clean[doc] == out + text[at:]
    assert len(rows[0].spans) > 690 and len(rows[2].spans) == 4


def unlike(spark, name, rows, frame):
    db = duckdb.connect()
    documents = pd.DataFrame([(r[0], r[1]) for r in rows], columns=["doc_id", "text"])  # noqa: F841
    want = db.sql(SQL[name]).df().sort_values("doc_id").reset_index(drop=True)
    got = frame.toPandas()[list(want.columns)].sort_values("doc_id").reset_index(drop=True)
    return [c for c in want.columns if not (want[c].eq(got[c]) | want[c].isna() & got[c].isna()).all()]


def test_line_dedup(spark, docs, none):
    found = line_dedup.deduplicate_lines(docs)
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[0] is None and PASSAGE not in texts[6] and texts[9] == "" and LONG.split("\n")[0] in texts[7]
    rows = [r for k, r in enumerate(ROWS) if k < len(TEXTS)]
    one = spark.createDataFrame(rows, SCHEMA)
    found = line_dedup.deduplicate_lines(one).withColumn("kept_sha256", F.sha2("text", 256))
    assert unlike(spark, "op1_line_dedup", rows, found) == []
    assert line_dedup.deduplicate_lines(none).count() == 0


def lines_to_keep(docs: list[tuple[int, str]], least: int = 50) -> dict[int, str]:
    """Every pair of places compared line by line, in the order of the documents."""
    places, kept = [], {}
    for doc, text in docs:
        lines = text.split("\n")
        full = [(k, line.strip()) for k, line in enumerate(lines) if line.strip()]
        places.append(full)
        gone = set()
        for source in places:
            for shift in range(-len(full), len(source)):
                if source is full and shift >= 0:
                    continue
                run = []
                for k in range(len(full) + 1):
                    if k < len(full) and 0 <= k + shift < len(source) and full[k][1] == source[k + shift][1]:
                        run.append(full[k])
                        continue
                    if sum(len(line.split()) for _, line in run) >= least:
                        gone |= set(range(run[0][0], run[-1][0] + 1))
                    run = []
        kept[doc] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
    return kept


def test_line_dedup_where_lines_occur_first_elsewhere(spark):
    passage = [sentence(500 + k, 10) for k in range(8)]
    foreign = [f"{line}\n{sentence(1000 + 10 * k + n, 45)}" for k, line in enumerate(passage) for n in range(8)]
    wide = [sentence(600 + k, 55) for k in range(4)]
    tail = [sentence(700, 20), sentence(701, 20), sentence(702, 47), "x y", "z"]
    parts = [
        "\n".join(foreign),
        *("\n\n".join([sentence(2000 + k, 12), *passage, sentence(2100 + k, 12)]) for k in range(2)),
        *("\n\n".join([f"{k}", *wide, f"{k}"]) for k in range(2)),
        *("\n \n".join([f"{k} a", *tail, f"{k} b"]) for k in range(2)),
        "\n".join([*passage, *passage[2:], *tail[1:], wide[3], wide[0], "y", *tail[:3]]),
        "\n".join(["a b c"] * 40),
    ]
    rng = random.Random(3)
    pool = [*passage, *tail, *wide, "a b c", ""]
    parts += ["\n".join(rng.choice(pool) for _ in range(30)) for _ in range(12)]
    docs = list(enumerate(parts))
    found = line_dedup.deduplicate_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r.doc_id: r.text for r in found.collect()} == lines_to_keep(docs)


def test_merkle(spark, docs, none):
    rows = [r for k, r in enumerate(ROWS) if k < len(TEXTS)]
    found = merkle.edited_fingerprints(spark.createDataFrame(rows, SCHEMA))
    found = found.withColumn("edited_sha256", F.sha2("edited", 256))
    assert unlike(spark, "op6_merkle_fingerprints", rows, found) == []
    assert merkle.edited_fingerprints(docs).count() == len(ROWS) and merkle.edited_fingerprints(none).count() == 0
    trees = spark.createDataFrame([("a\nb\n\nc\nd", "a\nb\n\nc\ne")], "l string, r string")
    trees = trees.select(merkle.differing(merkle.tree(F.col("l")), merkle.tree(F.col("r"))).alias("at"))
    assert [tuple(x) for x in trees.first().at] == [(1, 1)]


def test_near_duplicates(spark, none):
    rng = random.Random(4)
    texts = []
    for group in range(12):
        words = sentence(200 + group, 120).split()
        for _ in range(rng.randint(1, 12)):
            copy = list(words)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = "changed%d" % rng.randrange(9)
            texts.append(" ".join(copy))
    texts += [None, "", " \t", "one", "ONE", "one two", "Ünï x y z", texts[0], texts[0].upper()]
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append({tuple(words[k : k + 3]) for k in range(max(len(words) - 2, 1))} if words else set())
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in near_dups.near_duplicates(frame, 3, 85).collect()}
    assert [found[k].component_id for k in range(len(texts))] == group
    assert [found[k].n_shingles for k in range(len(texts))] == list(map(len, sets))
    assert near_dups.near_duplicates(none).count() == 0


def test_ann(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((3000, 16)).tolist()
    vectors[:9] = [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0], [], vectors[10], vectors[10], vectors[10]]
    frame = spark.createDataFrame(list(enumerate(vectors)) + [(None, vectors[10])], "vec_id long, embedding array<double>")
    usable = ann.usable(frame)
    found = ann.Index(usable, rows_per_part=256).search(usable.where("id % 50 = 0")).toPandas()
    x = np.array(vectors[6:])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for query, rows in found.groupby("query_id"):
        near = x @ x[query - 6]
        near[query - 6] = -2
        best = np.lexsort((np.arange(len(x)), -near.round(12)))[:5] + 6
        hits += len(set(best) & set(rows.vec_id))
        assert rows["rank"].tolist() == [1, 2, 3, 4, 5]
        assert np.allclose(rows.score, near[rows.vec_id - 6])
    assert hits >= 0.9 * 5 * found.query_id.nunique() and found.query_id.nunique() == 59
    empty = usable.where("id < 0")
    assert ann.Index(empty).search(empty).count() == 0


def test_ann_looks_on_where_parts_hold_too_few(spark):
    rng = np.random.default_rng(6)
    vectors = (rng.standard_normal((4, 1, 8)) * 20 + rng.standard_normal((4, 10, 8))).reshape(40, 8)
    rows = ann.usable(spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>"))
    index = ann.Index(rows, rows_per_part=8)
    assert index.weights.shape[1] == 4
    found = index.search(rows.where("id % 10 = 0"), k=30).toPandas()
    assert found.groupby("query_id").size().to_dict() == {0: 30, 10: 30, 20: 30, 30: 30}
    assert (found.query_id != found.vec_id).all() and not found.duplicated(["query_id", "vec_id"]).any()


def test_pipeline(spark, docs, none):
    assert len(corpus_pipeline.STAGES) == 5
    for table in (docs, none):
        kept = table
        for _, function in corpus_pipeline.STAGES[:-1]:
            kept = function(spark, kept, "")
            assert kept.columns == table.columns
            kept = spark.createDataFrame(kept.collect(), kept.schema)
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, "").toPandas()
        assert set(packed.doc_id.dropna()) == {r.doc_id for r in kept.collect() if r.doc_id is not None}
        if table is docs:
            by_id = {r.doc_id: r.text for r in kept.collect()}
            assert not {0, 1, 2, 3} & set(by_id) and 9 not in by_id and by_id[7] == LONG and "[SECRET]" in by_id[11]


def test_pipeline_keeps_one_of_each_group(spark):
    one, other, apart = sentence(800, 100), sentence(801, 100), sentence(802, 100)
    rows = [(5, f"{one} a"), (5, f"{one} b"), (7, f"{one} c"), (5, apart), (None, f"{other} a"), (None, f"{other} b")]
    rows += [(None, f"{sentence(803, 100)} a"), (9, f"{sentence(803, 100)} b"), (1, ""), (2, None)]
    docs = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, lang string")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "").collect()]
    groups = [rows[0:2], rows[3:4], rows[4:6], rows[7:8], rows[8:9], rows[9:]]
    assert len(kept) == 6 and all(len(set(kept) & set(group)) == 1 for group in groups)


def test_pipeline_without_labels(spark):
    rows = [(1, "some words", None), (2, "12 !!", None), (3, None, None), (4, "", None), (5, "x\u00e9", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()} == {1, 5}

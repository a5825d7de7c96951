"""Operators 11 to 13 against plain versions."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import docs, empty, rows  # noqa: F401
from larder.llm import merkle, queries, radix, whitening


def _plain_whitening(vectors, k=16):
    x = np.floor(np.array(vectors, float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    a = (fit * n - sums) / n
    values, basis = np.linalg.eigh(a.T @ a / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return n, ((x * n - sums) ** 2).sum(1), (x * n - sums) / n @ basis / np.sqrt(values), \
        values / (a * a).sum() * n


def _whitened(df):
    out = defaultdict(dict)
    for r in df.collect():
        out[r["vec_id"]][r["component"]] = r
    return out


@pytest.mark.parametrize("dims, n", [(12, 300), (40, 25), (24, 2_000)])
def test_whitening_equals_the_dense_form(spark, dims, n):
    r = np.random.default_rng(dims)
    v = r.standard_normal((n, dims)) * np.linspace(4, 0.5, dims) @ r.standard_normal((dims, dims))
    v[5:9] = v[4]
    table = spark.createDataFrame([(i, [float(y) for y in x], i) for i, x in enumerate(v)],
                                  "vec_id long, embedding array<double>, component int").repartition(5)
    got = _whitened(whitening.whitened(table, 16))
    count, deviation, z, explained = _plain_whitening(v)
    assert set(got) == set(range(n))
    for i in range(n):
        rows = got[i]
        numbers = range(1, min(16, dims, count - 1) + 1)
        assert sorted(rows) == list(numbers)
        assert {int(x["deviation"]) for x in rows.values()} == {int(deviation[i])}
        assert {x["n"] for x in rows.values()} == {count}
        assert np.allclose(np.abs([rows[c]["whitened"] for c in numbers]), np.abs(z[i]), atol=1e-7)
        assert np.allclose([rows[c]["explained"] for c in numbers], explained, rtol=1e-8)
        assert rows[1]["identity_error"] < 1e-9


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [0.0, 2.0]), (7, [3.0, 3.0]), (8, [1.0, 2.0, 3.0]), (9, [1e300, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whitened(table, 16).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in got) == [
        (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2), (False, 7, 1), (False, 7, 2),
        (True, 0, 1), (True, 0, 2)]
    assert {r["n"] for r in got} == {3}
    assert whitening.whitened(table.filter("vec_id < 0"), 16).count() == 0
    large = spark.createDataFrame([(0, [2.0 ** 33, 1.0]), (1, [-2.0 ** 33, 1.0]), (2, [0.0, 0.5])],
                                  "vec_id long, embedding array<double>")
    want = {0: [2 ** 39, 64], 1: [-2 ** 39, 64], 2: [0, 32]}
    for r in whitening.whitened(large, 2).collect():
        s = [sum(v[i] for v in want.values()) for i in (0, 1)]
        assert int(r["deviation"]) == sum((3 * want[r["vec_id"]][i] - s[i]) ** 2 for i in (0, 1))


def test_left_vectors_stay_orthogonal(spark):
    """Singular values that span ten powers of ten, and equal ones."""
    r = np.random.default_rng(3)
    u, _ = np.linalg.qr(r.standard_normal((400, 10)))
    w, _ = np.linalg.qr(r.standard_normal((10, 10)))
    v = u * np.array([1e8, 1e8, 1e6, 1e6, 1e5, 1e4, 1e3, 1e2, 50, 10]) @ w.T
    table = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)],
                                  "vec_id long, embedding array<double>")
    errors = {x["identity_error"] for x in whitening.whitened(table, 10).collect()}
    assert len(errors) == 1 and errors.pop() < 1e-6


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_radix_classes_equal_grouping_by_text(spark):
    long = "x" * 70_000
    texts = [(0, long + "a"), (1, long + "b"), (2, long + "a"), (3, None), (4, ""), (5, " \t\n"),
             (6, " "), (7, "é" * 40), (8, "é" * 40), (9, "e" * 80), (None, long + "b"), (10, "one two"),
             (10, "one\ttwo"), (11, "one  two"), (None, None), (12, "a" * 64), (13, "a" * 65), (14, "a" * 64),
             (-1, "b" * 2_000 + "c"), (15, "b" * 2_000 + "d"), (16, "b" * 2_000 + "c"), (17, "one two ")]
    table = spark.createDataFrame([(*t, "x", "y", 1, 2) for t in texts],
                                  "doc_id long, text string, row string, body string, g int, size int"
                                  ).repartition(4)
    groups = defaultdict(list)
    for i, t in texts:
        groups[_normal(t)].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    got = radix.classes(table, outputs={"text": F.col("body"), "was": F.col("own.text")}).collect()
    assert sorted((str(r["doc_id"]), _normal(r["was"])) for r in got) == sorted(
        (str(i), _normal(t)) for i, t in texts)
    for r in got:
        assert r["text"] == _normal(r["was"])
        assert (r["keep_id"], r["group_size"]) == (least[r["text"]], len(groups[r["text"]]))
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sorted(r["text"] for r in got if r["kept"]) == sorted(groups)
    kept = radix.deduplicated(table)
    assert kept.columns == table.columns and kept.count() == len(groups)
    assert radix.classes(table.filter("g < 0")).count() == 0


def test_radix_splits_a_large_group(spark):
    table = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.lit("copy " * 300)).otherwise(F.concat(F.lit("own " * 30), "id")).alias("text"))
    got = radix.classes(table)
    assert got.filter("group_size = 10000 and keep_id = 0").count() == 10_000
    assert got.filter("kept").count() == 20_001


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _plain_tree(leaves):
    """The root and each leaf's proof as (place, others)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    proofs = []
    for i in range(len(leaves)):
        own = []
        for level in levels[:-1]:
            a = i - i % 8
            own.append((i - a, "".join(level[a:i] + level[i + 1:a + 8])))
            i //= 8
        proofs.append(own)
    return levels[-1][0], proofs


def _plain_manifest(docs):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for d in docs:
        trees[d[2]].append((d[0] is not None, d[0] or 0, _leaf(d), d))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    made = {t: _plain_tree([x[2] for x in sorted(trees[t], key=lambda x: x[:3])]) for t in names}
    root, above = _plain_tree([made[t][0] for t in names])
    return sorted((str(x[1]) if x[0] else "None", x[2], made[t][0], root, tuple(p + q)) for t, q in zip(names, above)
                  for x, p in zip(sorted(trees[t], key=lambda x: x[:3]), made[t][1]))


_KIND = "doc_id long, source string, lang string, n_chars long, text string, tree int, pos int, row int"


@pytest.mark.parametrize("chunk_levels", [1, 5])
def test_manifest_equals_the_plain_tree(spark, monkeypatch, chunk_levels):
    monkeypatch.setattr(merkle, "LEVELS", chunk_levels)
    monkeypatch.setattr(merkle, "CHUNK", 8 ** chunk_levels)
    r = np.random.default_rng(2)
    docs = [(int(i), f"s{i % 3}", ["de", None, "", "é", "zz"][i % 5] if i % 7 else "en", int(i) if i % 4 else None,
             "Tëxt " * int(r.integers(0, 5)) if i % 11 else None) for i in range(700)]
    docs += [docs[3], docs[3], (None, None, None, None, None), (5000, "x", "alone", 1, "Only one")]
    table = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], _KIND).repartition(6)
    made = merkle.manifest(table, ["doc_id", "source", "lang", "n_chars", "text"])
    ok = merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")
    got = made.withColumn("ok", ok).collect()
    assert all(x["ok"] for x in got)
    assert sorted((str(x["doc_id"]), x["leaf"], x["subroot"], x["root"],
                   tuple((s["place"], s["siblings"]) for s in x["proof"])) for x in got) == _plain_manifest(docs)


def test_manifest_of_no_rows_and_one(spark):
    table = spark.createDataFrame([(1, "s", "en", 2, "ab", 0, 0, 0)], _KIND)
    assert merkle.manifest(table.filter("doc_id = 2"), ["doc_id"]).count() == 0
    one = merkle.manifest(table, ["doc_id", "text"]).first()
    assert one["leaf"] == one["subroot"] == one["root"] == _leaf((1, "ab")) and one["proof"] == []


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    """A small set of tables for the registered queries."""
    path = str(tmp_path_factory.mktemp("tables"))
    langs = F.element_at(F.array(F.lit("en"), F.lit(None).cast("string"), F.lit("de")),
                         (F.col("doc_id") % 3 + 1).cast("int"))
    docs.select("doc_id", "text", langs.alias("lang"), F.lit("src").alias("source"),
                F.length("text").cast("long").alias("n_chars")).write.parquet(f"{path}/documents.parquet")
    r = np.random.default_rng(1)
    spark.createDataFrame([(i, [float(x) for x in r.standard_normal(20)]) for i in range(60)],
                          "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path


def test_query_11(spark, folder):
    made = queries.op11_lanczos_whitening(spark, folder)
    assert dict(made.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                                 "whitened": "double", "explained": "double", "identity_error": "double"}
    table = sorted((x["vec_id"], x["embedding"]) for x in spark.read.parquet(f"{folder}/embeddings.parquet").collect())
    _, deviation, z, _ = _plain_whitening([v for _, v in table])
    for r in made.collect():
        assert r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["whitened"]) == pytest.approx(abs(z[r["vec_id"], r["component"] - 1]), abs=1e-8)


def test_query_12(spark, folder, rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[_normal(t)].append(i)
    want = {i: (min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest())
            for t, ids in groups.items() for i in ids}
    got = queries.op12_radix_dedup(spark, folder)
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got.collect()} == want
    assert dict(got.dtypes)["group_size"] == "bigint"


def test_query_13(spark, folder, rows):
    docs = [(i, "src", ["en", None, "de"][i % 3], None if t is None else len(t), t) for i, t in rows]
    want = {d: (leaf, sub, root, proof) for d, leaf, sub, root, proof in _plain_manifest(docs)}
    for r in queries.op13_merkle_manifest(spark, folder).collect():
        leaf, sub, root, proof = want[str(r["doc_id"])]
        assert (r["leaf"], r["subroot"], r["root"]) == (leaf, sub, root)
        assert r["proof_sha256"] == _h(*(s for _, s in proof))
        doc = next(d for d in docs if d[0] == r["doc_id"])
        fold = leaf
        if zlib.crc32(str(doc[0]).encode()) % 3 == 0:
            low = doc[4] and re.sub("[A-Z]", lambda m: m[0].lower(), doc[4])
            fold = _leaf((*doc[:4], low))
        for place, others in proof:
            fold = _h(others[:64 * place], fold, others[64 * place:])
        assert (r["folded_root"], r["verified"]) == (fold, fold == root)

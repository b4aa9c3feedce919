import importlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapwise.llm.nearest import Index, nearest, perturbations
from gapwise.llm.quality import Model, co_train, fit, score
from gapwise.llm.top_k import exact_top_k


def frames(spark, vectors, every):
    kind = "vec_id long, vector array<double>"
    rows = spark.createDataFrame(vectors, kind).selectExpr("*", "1 AS g", "2 AS s", "'x' AS rank")
    return rows, rows.where(f"vec_id % {every} = 0").withColumnRenamed("vec_id", "query_id")


def brute(vectors, every, k, usable, kind=float):
    ids, rows = np.array([i for i, v in vectors if usable(v)]), [np.array(v, kind) for _, v in vectors if usable(v)]
    width = max((len(v) for v in rows), default=0)
    x = np.array([np.pad(v, (0, width - len(v))) for v in rows])
    found = set()
    for q in {i for i in ids.tolist() if i % every == 0}:
        scores = (x * x[np.flatnonzero(ids == q)[0]]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        found |= {(q, n + 1, int(ids[j]), scores[j].item()) for n, j in enumerate(order)}
    return found


def whole(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def some_vectors(seed, n, width, scale):
    rng = np.random.default_rng(seed)
    vectors = [(i, [float(x) for x in np.floor(scale * rng.standard_normal(width))]) for i in range(n)]
    vectors += [(n + i, vectors[3][1]) for i in range(60)]  # ties
    return vectors + [(9000, None), (9050, [1.0, None] + [0.0] * (width - 2)), (9100, [float("nan")] * width), (9150, [float("inf")] * width), (9200, [5.0, -2.0]), (9250, [0.0] * width), (9300, [])]


@pytest.mark.parametrize(("scale", "width"), [(30, 16), (3, 4), (2.0**28, 8)])
def test_exact_top_k_is_that_of_brute_force(spark, scale, width):
    vectors = some_vectors(1, 1500, width, scale)
    rows, queries = frames(spark, vectors, 50)
    rows, queries = (f.withColumn("vector", F.when(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e300)), F.col("vector")).cast("array<long>")) for f in (rows, queries))
    found = {tuple(r) for r in exact_top_k(rows, queries).collect()}
    assert found == brute(vectors, 50, 5, whole, np.int64)


def test_few_candidates_and_none(spark):
    for vectors in ([], [(0, [1.0])], [(0, [1.0]), (1, [2.0]), (2, [2.0])]):
        rows, queries = frames(spark, vectors, 50)
        want = [(0, 1, 1), (0, 2, 2)] if len(vectors) == 3 else []
        assert [tuple(r)[:3] for r in nearest(rows, queries).orderBy("rank").collect()] == want
        rows, queries = (f.withColumn("vector", F.col("vector").cast("array<long>")) for f in (rows, queries))
        assert [tuple(r)[:3] for r in exact_top_k(rows, queries).orderBy("rank").collect()] == want


@pytest.mark.parametrize("n", [10, 20, 40])
def test_spread_vectors_are_all_found_if_they_are_few(spark, n):
    x = np.vstack([np.eye(n // 2), -np.eye(n // 2)])  # orthogonal and opposite ones
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    rows, queries = frames(spark, vectors, 1)
    found = [tuple(r) for r in nearest(rows, queries).collect()]
    assert {(q, r) for q, r, _, _ in found} == {(q, r) for q in range(n) for r in range(1, min(20, n - 1) + 1)}
    assert len(found) == len({(q, i) for q, _, i, _ in found}) and all(q != i for q, _, i, _ in found)
    if n <= 20:
        assert set(found) == brute(vectors, 1, 20, whole)


def test_nearest_finds_nine_of_ten_and_scores_exactly(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64)) * rng.uniform(0.8, 1.2, (4000, 1))
    vectors = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000 + i, x[40].tolist()) for i in range(30)] + [(6000, None), (6020, [0.0] * 64), (6040, [None] * 64)]
    rows, queries = frames(spark, vectors, 20)
    found = {tuple(r) for r in nearest(rows, queries).collect()}
    want = brute(vectors, 20, 20, lambda v: whole(v) and any(v))
    scores = {(q, i): s for q, _, i, s in want}
    hits = [(q, i) for q, _, i, _ in found if (q, i) in scores]
    assert len(hits) >= 0.9 * len(want)
    by_id = dict(vectors)
    assert all(abs(s - float(np.dot(by_id[q], by_id[i]))) < 1e-9 for q, _, i, s in found)
    copies = sorted((r, i) for q, r, i, _ in found if q == 40)
    assert [i for _, i in copies] == list(range(5000, 5020))  # ties to smaller ids


def test_perturbations_come_by_cost_and_never_change_a_hash_twice():
    sets = perturbations(5, 100)
    assert sets[0] == () and sets[1] == (0,) and len(set(sets)) == len(sets) == 100
    assert not any(9 - j in s for s in sets for j in s)
    assert Index().probes <= 3**5


def labelled(spark, n):
    rows = []
    for i in range(n):
        good = i % 5 != 0
        text = " ".join(f"word{(i * 31 + k * 7) % 97}" for k in range(30)) + "." if good else "%%% $$$ ### " * 12
        rows.append((i, text, ["en", "de", None][i % 3], f"src{i % 4}" if good else "spam", len(text), int(good)))
    rows += [(n, None, None, None, None, 1), (n + 1, "", "en", "src1", 0, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality int")
    return table.drop("quality"), table.where("doc_id % 3 > 0").select("doc_id", "quality")


def test_classifier_separates_held_out_rows(spark):
    docs, labels = labelled(spark, 1500)
    labels = labels.union(spark.createDataFrame([(1, None), (2, 7), (None, 1), (99_999, 0)], "doc_id long, quality int"))
    model = fit(docs, labels)
    assert len(model.rounds) == 4 and all(a > 0 and b > 0 for a, b in model.rounds)
    held = score(docs.selectExpr("*", "'old' AS quality_score", "1 AS _x", "2 AS _scores", "3 AS __SCORES"), model)
    assert {"_x", "_scores", "__SCORES"} < set(held.columns) and held.where("_scores = 2 and __SCORES = 3").count() == 1502
    found = held.collect()
    assert len(found) == 1502
    rest = [r for r in found if r.doc_id % 3 == 0 and r.doc_id < 1500]  # no label of theirs was seen
    assert np.mean([(r.quality_score >= 0.5) == (r.doc_id % 5 != 0) for r in rest]) > 0.99
    assert all(0 <= s <= 1 for r in found for s in (r.content_score, r.metadata_score, r.quality_score))


def test_without_labels_everything_stays(spark):
    docs, labels = labelled(spark, 60)
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert fit(docs, none) == Model()
    assert score(docs, Model()).where("quality_score = 1").count() == docs.count()
    assert score(docs.limit(0), Model()).count() == 0
    assert score(docs.select("doc_id"), Model()).count() == docs.count()


def test_views_teach_each_other_and_together_know_more():
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 3000).astype(float)
    views = [rng.standard_normal((3000, 4)) + s * y[:, None] for s in (0.6, 0.9)]
    known = np.where(np.arange(3000) < 120, y, np.nan)
    right = lambda p: float(((p[120:] >= 0.5) == (y[120:] == 1)).mean())
    alone, taught = (co_train(*views, known, rounds=r) for r in (0, 4))
    assert taught.rounds == ((taught.rounds[0]),) * 4 and min(taught.rounds[0]) >= 2 and alone.rounds == ()
    content, metadata, both = map(right, taught.scores(*views))
    assert both > max(content, metadata) + 0.01 and both > 0.81  # 0.86 is the best that any rule can reach here
    assert content > right(alone.scores(*views)[0]) - 0.01


def test_repeated_and_null_ids_are_drawn_alike(spark):
    docs, labels = labelled(spark, 300)
    odd = spark.createDataFrame([(None, f"text {i}", "en", "src1", 6) for i in range(50)] + [(1, f"other {i}", "en", "src1", 7) for i in range(50)], docs.schema)
    many = docs.union(odd).union(odd).repartition(5)
    a, b = fit(many, labels, unlabelled=40), fit(many.repartition(3), labels.union(labels), unlabelled=40)
    assert a.rounds == b.rounds and np.allclose(a.content.weights, b.content.weights)


def test_pipeline_keeps_each_stage_s_promise(spark):
    pytest.importorskip("public_tokenizers")
    pipeline = importlib.import_module("corpus_pipeline")
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(1, None), (2, ""), (3, "write to x@y.de now, or call +49 30 1234567, please do"), (4, "a clean text"), (4, "a clean text")]
    odd = spark.createDataFrame([(1_000_000 + i, t, "en", "src1", None if t is None else len(t)) for i, t in texts], docs.schema)
    unique = pipeline.deduplication(spark, docs.union(odd), sf_dir).cache()
    assert unique.columns == docs.columns and unique.where("doc_id >= 1000000").count() == 4
    assert unique.count() < docs.count() + 4 and unique.select("doc_id").distinct().count() == unique.count()
    clean = pipeline.personal_data(spark, unique, sf_dir)
    assert clean.columns == docs.columns and clean.count() == unique.count()
    assert clean.where("doc_id = 1000003").first()[1] == "write to [EMAIL] now, or call [PHONE], please do"
    assert clean.where("n_chars != char_length(text)").count() == 0
    kept = pipeline.quality(spark, docs, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    assert kept.columns == docs.columns and kept.join(good, "doc_id", "left_semi").count() >= 0.97 * good.count()
    assert pipeline.packing(spark, clean, sf_dir).select("doc_id").distinct().count() == clean.count()


def test_pipeline_stages_take_repeated_ids_null_ids_and_clashing_names(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    pipeline = importlib.import_module("corpus_pipeline")
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:-1], "other"])
    rows = [(None, " ".join(words)), (None, near), (4, "one two three four five six"), (4, "one two three four five six"), (4, None), (None, ""), (None, None)]
    rows += [(7, "x y z " + " ".join(words[50:150])), (7, "x y z " + " ".join(words[50:149]))]
    kind = "doc_id long, text string, _id int, _text int, _spans int, _scores int, quality_score int, TEXT_key int, _kept_id int, `a.b` int"
    docs = spark.createDataFrame([(*r, *range(8)) for r in rows], kind)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    left = docs
    for _, stage in pipeline.STAGES[:3]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns
    assert sorted(((r[0] or 0), len((r[1] or "").split())) for r in left.collect()) == [(0, 0), (0, 0), (0, 200), (4, 0), (4, 6), (7, left.where("doc_id = 7").first()[1].count(" ") + 1)]
    for some in (docs, docs.limit(0)):  # the whole chain
        folder = tmp_path / f"given-{some.count()}"
        some.select("doc_id", "text").write.parquet(str(folder / "documents.parquet"))
        labels.write.parquet(str(folder / "labels.parquet"))
        packed = pipeline.run(spark, str(folder))
        assert packed.count() == (6 if some is docs else 0)

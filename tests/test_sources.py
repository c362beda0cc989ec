import pytest
from pyspark.sql import functions as F

from vitrine import schemas
from vitrine.sources import pairs, runs
from vitrine.sources.tables import Tables


def schema(spark, *names):
    return spark.createDataFrame([], ", ".join(f"{n} string" for n in names)).schema


def test_roles_by_name(spark):
    s = schema(spark, "thumb", "wild_photo", "cls", "class_name")
    assert pairs.infer_roles(s, ["thumb", "wild_photo"]) == {"anchor": "wild_photo", "positive": "thumb", "category": "class_name"}
    s = schema(spark, "left", "right", "x")
    assert pairs.infer_roles(s, ["left", "right"]) == {"anchor": "left", "positive": "right", "category": None}
    with pytest.raises(ValueError):
        pairs.infer_roles(s, ["left"])


def test_categories(spark):
    df = spark.createDataFrame([(0, "x"), (2, "y")], "label int, name string")
    get = lambda c: [r[0] for r in df.select(c).collect()]
    assert get(pairs.decode_category(df, "label", ["a", "b", "c"])) == ["a", "c"]
    assert get(pairs.decode_category(df, "label")) == ["0", "2"]
    assert get(pairs.decode_category(df, "name", ["a"])) == ["x", "y"]
    assert get(pairs.decode_category(df, None)) == ["unknown", "unknown"]


def test_ingest(spark):
    df = spark.createDataFrame([(1, "a1", "p1"), (2, None, "p2"), (12345678, "a3", "p3")], "key int, a string, p string")
    products, posts = pairs.ingest_pairs(df, "key", "a", "p", F.lit("bag"), "here", "2024-01-31")
    assert {(r["product_id"], r["image_path"]) for r in products.collect()} == {("p0000001", "p1"), ("p12345678", "p3")}
    assert {(r["post_id"], tuple(r["linked_products"])) for r in posts.collect()} == {("post_p0000001", ("p0000001",)), ("post_p12345678", ("p12345678",))}
    assert schemas.conform(products, schemas.PRODUCTS).count() == 2
    assert schemas.conform(posts, schemas.POSTS).count() == 2


def test_numeric_categories_are_flagged(spark):
    df = spark.createDataFrame([("3",), ("3",), ("bag",), (None,)], "category string")
    assert {(r["category"], r["n"], r["is_numeric"]) for r in pairs.category_quality(df).collect()} == {("3", 2, True), ("bag", 1, False), (None, 1, False)}


def test_newest_run_wins(spark, tmp_path):
    inbox = str(tmp_path)
    for stamp, n in [("20240102T000000", 3), ("20240101T000000", 5)]:
        products = spark.range(n).withColumnRenamed("id", "product_id")
        runs.write_run(products, products, spark.createDataFrame([(n, "enc")], "n_products int, encoder_repo string"), inbox, stamp)
    (tmp_path / "manifest_20231231T000000.json").write_text('{"n_products": 1, "encoder_repo": "old"}\n')
    stamp, products, _ = runs.latest_run(spark, inbox)
    assert (stamp, products.count()) == ("20240102T000000", 3)
    assert runs.manifests(spark, inbox).count() == 3


def test_manifest_checks(spark):
    manifest = spark.createDataFrame([("r1", 64, "enc", 90, "cpu"), ("r2", 32, None, 89, "cuda")], "stamp string, embedding_dim int, encoder_repo string, n_products int, device string")
    got = {(r["stamp"], r["check"]): (r["passed"], r["severity"]) for r in runs.check_manifest(manifest, 64, "enc", 100).collect()}
    assert got == {
        ("r1", "embedding_dim"): (True, "fatal"), ("r1", "encoder_repo"): (True, "fatal"), ("r1", "n_products"): (True, "fatal"), ("r1", "device"): (False, "note"),
        ("r2", "embedding_dim"): (False, "fatal"), ("r2", "encoder_repo"): (False, "fatal"), ("r2", "n_products"): (False, "fatal"), ("r2", "device"): (True, "note"),
    }


def test_paths_and_rebuilt_tables(spark):
    items = spark.createDataFrame([(1, "bag"), (2, "hat")], "product_id int, category string")
    shipped = spark.createDataFrame([(1, "sample/1.jpg")], "product_id int, path string")
    resolved = runs.resolve_image_path(items, shipped, "r7")
    assert {(r["product_id"], r["image_path"]) for r in resolved.collect()} == {(1, "sample/1.jpg"), (2, "marker://r7/2")}
    assert [r["product_id"] for r in runs.viewable(resolved).collect()] == [1]
    assert schemas.conform(runs.rebuild_catalogue(resolved, "r7", "2024-01-31"), schemas.PRODUCTS).count() == 2
    queries = resolved.selectExpr("cast(product_id AS string) AS product_id", "'p' AS post_id", "image_path", "category", "'small' AS size_band", "'none' AS occlusion")
    rebuilt = schemas.conform(runs.rebuild_eval_queries(queries, "2024-01-31"), schemas.EVAL_QUERIES)
    assert rebuilt.first()["relevance_map"] in ({"1": 1.0}, {"2": 1.0})


def test_tables_check_schemas_and_prune_days(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    syncs = spark.createDataFrame([("a", 5)], "index_name string, n_vectors int")
    tables.append(syncs, "monitoring", "index_syncs", schemas.INDEX_SYNCS, stamp="synced_at")
    tables.append(syncs, "monitoring", "index_syncs", schemas.INDEX_SYNCS, stamp="synced_at")
    assert tables.read("monitoring", "index_syncs", ["n_vectors"], schemas.INDEX_SYNCS).count() == 2
    with pytest.raises(ValueError, match="synced_at"):
        tables.append(syncs, "monitoring", "index_syncs", schemas.INDEX_SYNCS)
    tables.replace(syncs.withColumn("extra", F.lit(1)), "gold", "t")
    tables.replace(syncs, "gold", "t")
    assert tables.read("gold", "t").columns == ["index_name", "n_vectors"]
    events = spark.range(10).selectExpr("id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id AS int)) AS event_ts")
    tables.append_events(events, "bronze", "search_events")
    from vitrine.operators.monitor import since

    recent = since(tables.read_events("bronze", "search_events", "2024-01-01"), "2024-01-10", 2)
    assert recent.count() == 3
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-08" in plan or "19730" in plan

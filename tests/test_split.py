"""The stratified split against a plain ranking, and its plan."""

from pyspark.sql import functions as F


def test_sides_are_the_smallest_hashes_of_each_class(spark):
    from vitrine.operators.ml import stratified_split
    rows = [(i, i % 3 == 0, f"t{i}") for i in range(100)] + [(None, True, "n"), (7, None, "no label")]
    df = spark.createDataFrame(rows, "id long, y boolean, text string").repartition(5)
    got = stratified_split(df, "y", "id", 0.2, 42)
    assert got.columns == ["id", "y", "text", "side"]
    h = {r.id: r.h for r in df.select("id", F.xxhash64("id", F.lit(42)).alias("h")).collect()}
    for y in (True, False):
        ids = sorted((i for i, z, _ in rows if z == y), key=lambda i: (h[i], i is not None, i))
        test = {r.id for r in got.collect() if r.y == y and r.side == "test"}
        assert test == set(ids[:-(-len(ids) // 5)])
    assert got.count() == 101


def test_copies_of_the_last_id_are_split_to_the_exact_size(spark):
    from vitrine.operators.ml import stratified_split
    df = spark.createDataFrame([(i // 10, i % 2, f"t{i}") for i in range(60)], "id long, y int, text string")
    got = {(r.y, r.side): r.n for r in stratified_split(df, "y", "id", 0.2).groupBy("y", "side").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, "test"): 6, (0, "train"): 24, (1, "test"): 6, (1, "train"): 24}


def test_the_rows_themselves_are_not_shuffled(spark):
    from vitrine.operators.ml import stratified_split
    df = spark.range(1000).selectExpr("id", "id % 2 AS y", "repeat('x', 100) AS text")
    plan = stratified_split(df, "y", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "RepartitionByExpression" not in plan


def test_training_input_is_cut_by_size(spark):
    from vitrine.operators.ml import sized
    assert sized(spark.range(40_001)).rdd.getNumPartitions() == 5
    assert sized(spark.range(10), 10).rdd.getNumPartitions() == 1


def test_a_known_number_of_rows_gives_the_same_vocabulary(spark):
    from vitrine.operators.ml import feature_names, feature_pipeline
    words = [f"word{i}" for i in range(30)]
    rows = [(i, "t", "always " + " ".join(words[i % 7:i % 11 + 3]), "p", i, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, title string, description string, platform string, reviews_count int, target int")
    plain = sorted(feature_names(feature_pipeline().fit(df)))
    assert sorted(feature_names(feature_pipeline(rows=40).fit(df))) == plain and not any("always" in n for n in plain)

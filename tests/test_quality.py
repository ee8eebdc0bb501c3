from hitlist.operators import quality


def test_checks_find_bad_rows(spark):
    songs = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "SongID long, SongTitle string")
    pk = {r.value: r.n_rows for r in quality.pk_violations(songs, "songs", ["SongID"]).collect()}
    assert pk == {"1": 2, "NULL": 1}
    names = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "ArtistName string")
    assert [r.value for r in quality.unique_violations(names, "artists", "ArtistName").collect()] == ["a"]
    feats = spark.createDataFrame([(1, 5, "Primary"), (9, 6, "Lead"), (None, 7, None)], "SongID long, ArtistID long, Contribution string")
    fk = [r.value for r in quality.fk_violations(feats, "features", "SongID", songs, "SongID", "songs").collect()]
    assert fk == ["9"]
    dom = [r.value for r in quality.domain_violations(feats, "features", "Contribution", ["Primary", "Feature"]).collect()]
    assert dom == ["Lead"]
    long = spark.createDataFrame([("x" * 101,), ("ok",)], "ArtistName string")
    assert quality.length_violations(long, "artists", "ArtistName", 100).count() == 1
    two = spark.createDataFrame([("x" * 101, "ok"), (None, "y" * 11)], "a string, b string")
    got = {(r.rule, len(r.value), r.n_rows) for r in quality.too_long(two, "t", {"a": 100, "b": 10}).collect()}
    assert got == {("length (a) <= 100", 101, 1), ("length (b) <= 10", 11, 1)}
    assert quality.union_all([quality.pk_violations(songs, "songs", ["SongID"])]).columns == quality.VIOLATION_COLUMNS


RULES = {
    "songs": quality.Rules(key=("SongID",), unique=("SongTitle",), limits={"SongTitle": 5}),
    "features": quality.Rules(references={"SongID": ("songs", "SongID")}, allowed={"Contribution": ("Primary",)}),
}


def test_model_checks_list_what_the_single_checks_list(spark):
    songs = spark.createDataFrame([(1, "x"), (1, "y"), (None, "toolong"), (4, "x"), (5, None)], "SongID long, SongTitle string")
    feats = spark.createDataFrame([(1, "Primary"), (3, "Lead"), (None, None), (5, "Primary")], "SongID long, Contribution string")
    single = quality.union_all(
        [
            quality.pk_violations(songs, "songs", ["SongID"]),
            quality.unique_violations(songs, "songs", "SongTitle"),
            quality.too_long(songs, "songs", {"SongTitle": 5}),
            # 3 lies between the smallest and the largest song, but there is a gap
            quality.fk_violations(feats, "features", "SongID", songs, "SongID", "songs"),
            quality.domain_violations(feats, "features", "Contribution", ["Primary"]),
        ]
    )
    got = quality.violations({"songs": songs, "features": feats}, RULES)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, single.collect())) and single.count() == 6


def test_counts_prove_a_sound_model_without_a_join(spark, monkeypatch):
    songs = spark.createDataFrame([(i, f"s{i}") for i in range(7, 20)], "SongID long, SongTitle string")
    feats = spark.createDataFrame([(7, "Primary"), (19, None), (None, "Primary")], "SongID long, Contribution string")

    def listed(*_):
        raise AssertionError("listed row by row")

    for name in ("pk_violations", "unique_violations", "fk_violations", "domain_violations", "too_long"):
        monkeypatch.setattr(quality, name, listed)
    got = quality.violations({"songs": songs, "features": feats}, RULES)
    assert got.count() == 0 and got.columns == quality.VIOLATION_COLUMNS
    empty = {"songs": songs.limit(0), "features": feats.limit(0)}
    assert quality.violations(empty, RULES).count() == 0


def test_references_are_counted_before_they_meet_the_parent(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, t string")
    got = quality.fk_violations(child, "child", "k", parent, "k", "parent")
    assert sorted((r.value, r.n_rows) for r in got.collect()) == [("7", 2), ("9", 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert next(n for n, x in enumerate(plan) if "Join LeftAnti" in x) < next(n for n, x in enumerate(plan) if "Aggregate" in x)

"""Whole tables, feature registry, models, sources and sinks on small frames."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from callgrid.operators import features as ft, modeling as m
from callgrid.plans import demand, dictionary, incident, incident_features as inf, training
from callgrid.sources import readers as rd, writers as wr
from callgrid.streaming.demand import hourly_demand_stream


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def inputs(spark):
    at = [(1, "E1", "2014-05-01 10:05", 1, 0.5, 0.5), (2, "E2", "2014-05-01 11:00", 2, 1.5, 0.5), (3, "E3", "2014-05-02 10:00", None, 9.0, 9.0), (4, "E4", "2014-05-02 12:00", 1, 0.5, 0.5), (5, "E5", "2010-01-01 00:00", 1, 0.5, 0.5)]
    cad = [(e, ts(t), ts(t) + dt.timedelta(minutes=30), "911", "home" if i % 2 else None, d, x, y) for i, e, t, d, x, y in at]
    return {
        "incidents": spark.createDataFrame(cad + cad[:1], "i_eventnumber string, i_ttimecreate timestamp, i_ttimeclosed timestamp, i_kcallsource string, i_callerphonetype string, i_kdisposition1 int, x double, y double"),
        "dispositions": spark.createDataFrame([(1, "MT", "DONE"), (2, "AST", "NO ONE")], "idi_disposition_pk int, idi_dispositioncode string, idi_dispositiontext string"),
        "units": spark.createDataFrame([("E1", "M05"), ("E1", "E19"), ("E2", "E19"), ("E3", "A0123")], "i_eventnumber string, pun_unitid string"),
        "reports": spark.createDataFrame([("E1", "op", "x CF/1", "06D1", "breath"), ("E1", "op", "x CF/1", "17A2", "fall"), ("E2", "op", "CP/2", "17A2", "fall"), ("E3", "oq", None, "STRUCT", "fire"), ("E4", "oq", None, "FADV", "advice"), ("E5", "op", None, "17A2", "fall")], "i_eventnumber string, poc_operatorname string, ico_comment string, iti_typeid string, iti_typetext string"),
        "dictionary": spark.createDataFrame([("6D1", "BREATHING", "E1 MT"), ("17A2", "FALLS", "E1")], "code string, incident_type string, compliment string"),
        "care": {
            "t_incident": spark.createDataFrame([("E1", 10)], "INCIDENTN string, KEY_INCIDENT int"),
            "t_case": spark.createDataFrame([(10, 100, 7), (10, 101, 8)], "KEY_INCIDENT int, KEY_CASE int, KEY_PATIENT int"),
            "t_comment": spark.createDataFrame([(100, "refusal signed"), (101, "a note")], "KEY_CASE int, COMMENTTEXT string"),
            "t_patient": spark.createDataFrame([(7, "F", 40, "w", "45202"), (8, "M", 61, "b", "45203")], "KEY_PATIENT int, GENDERCODE string, AGE int, RACECODE string, POSTCODE string"),
        },
        "stations": spark.createDataFrame([("S1", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]), ("S2", [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0)])], "station_name string, ring array<struct<x:double,y:double>>"),
    }


@pytest.fixture(scope="module")
def table(inputs):
    groups = inputs["stations"].withColumnRenamed("station_name", "geoid")
    i = inputs
    return incident.incident_table(i["incidents"], i["dispositions"], i["units"], i["reports"], i["dictionary"], i["care"], i["stations"], groups).cache()


def test_incident_table(table):
    got = {r["incident"]: r for r in table.collect()}
    assert sorted(got) == ["E1", "E2", "E3"]
    e1 = got["E1"]
    assert (e1["dispatch_code"], e1["code_type"], e1["code_level"], e1["dispatch_type"]) == ("6D1", "6", "D", "BREATHING")
    assert (e1["trns_to_hosp"], e1["m_sent"], e1["m_required"], e1["operator_agency"]) == (True, True, True, "CF")
    assert (e1["comments"], e1["pt_age"], e1["pt_gender"], e1["station_name"], e1["time_hour"]) == ("a note | refusal signed", 61, "M", "S1", 10)
    assert (got["E2"]["trns_to_hosp"], got["E2"]["m_sent"], got["E2"]["m_required"], got["E2"]["operator_agency"]) == (False, False, False, "CP")
    assert (got["E3"]["station_name"], got["E3"]["code_type"], got["E3"]["code_level"], got["E3"]["operator_agency"]) == (None, "STRUCT", None, "NA")
    assert len(table.columns) == 30


def test_demand_table(table, inputs):
    got = demand.demand_table(table, inputs["stations"], F.lit("2014-05-01 09:00:00").cast("timestamp"), F.lit("2014-05-01 12:00:00").cast("timestamp"))
    assert got.count() == 8
    busy = {r["pk_demand"]: (r["total_incidents"], r["trns_to_hosp"]) for r in got.where("total_incidents > 0").collect()}
    assert busy == {"2014-05-01 10:00:00_S1": (1, 1), "2014-05-01 11:00:00_S2": (1, 0)}


def test_all_incident_features(spark, table):
    census = {t: spark.createDataFrame([(y, "15000US" + g, 10.0, 4.0, 3.0, 2.0, 1.0) for y in (2010, 2012, 2013) for g in ("S1", "S2")], f"year int, geoid string, {cols}") for t, cols in {
        "B19013": "b19013001 double, a double, b double, c double, d double", "B01002": "b01002001 double, a double, b double, c double, d double",
        "B27010": "b27010001 double, b27010017 double, b27010033 double, b27010050 double, b27010066 double",
        "B15003": "b15003001 double, b15003022 double, b15003023 double, b15003024 double, b15003025 double",
        "B02001": "b02001001 double, b02001002 double, b02001003 double, c double, d double"}.items()}
    weather = spark.createDataFrame([(dt.date(2014, 5, 1), "TMAX", 95.0), (dt.date(2014, 5, 1), "TMIN", 20.0), (dt.date(2014, 5, 2), "TMAX", 70.0), (dt.date(2014, 5, 1), "WT05", 1.0), (dt.date(2013, 1, 1), "TMAX", 1.0)], "date date, datatype string, value double")
    moon = spark.createDataFrame([(dt.date(2014, 5, 3), "Full Moon"), (dt.date(2014, 5, 1), "New Moon")], "date date, phase string")
    names = sorted(inf.INCIDENT_FEATURES.functions) + ["code_type", "pt_age"]
    specs, _ = ft.load_specs([{"name": n, "type": "cat" if n == "code_type" else "float"} for n in names])
    out = inf.INCIDENT_FEATURES.apply(table, specs, "incident", {"census": census, "weather": weather, "weather_kinds": ["TMAX", "TMIN"], "moon": moon})
    got = {r["incident"]: r for r in out.collect()}
    e1, e3 = got["E1"], got["E3"]
    assert (e1["acs_income"], e1["acs_no_insurance"], e1["acs_edu"], e1["acs_white"], e1["acs_black"]) == (10.0, 1.0, 1.0, 0.4, 0.3)
    assert (e1["temp_above"], e1["temp_below"], e3["temp_above"], e3["temp_below"]) == (True, True, False, None)
    assert (e1["weather_event_hail"], e3["weather_event_hail"], e1["common_weather_tmax"], e3["common_weather_tmin"]) == (1.0, 0.0, 95.0, 0.0)
    assert (e1["within_1day_full_moon"], e3["within_1day_full_moon"], e1["trns_or_refused"], got["E2"]["trns_or_refused"]) == (False, True, True, False)
    assert (e1["building_type"], got["E2"]["building_type"], e1["incident_duration"], got["E2"]["operator_experience"]) == ("home", "other", 30.0, 1)
    assert (got["E2"]["total_transports_lasthour"], e3["frac_trans_1day"], e3["lag_24h_station_incidents"]) == (1, 0.5, 0)
    types = {r["name"]: r["type"] for r in ft.type_table(spark, specs, out.columns[1:]).collect()}
    assert types["code_type"] == "cat" and types["weather_event_hail"] == "float"
    assert ft.categorical(ft.type_table(spark, specs, out.columns[1:])) == ["code_type"]


def test_feature_order_and_cycles():
    fs = ft.FeatureSet()
    fs.feature("a", needs="z")(None)
    fs.feature("z")(None)
    assert fs.order(["a", "z"]) == ["z", "a"]
    fs.feature("p", needs="q")(None)
    fs.feature("q", needs="p")(None)
    with pytest.raises(ValueError):
        fs.order(["p"])
    with pytest.raises(ValueError):
        ft.FeatureSpec("x", "number")


def test_specs_from_yaml(tmp_path):
    path = tmp_path / "spec.yaml"
    path.write_text("features:\n  - {name: a, type: cat, deps: [b], incl: False}\n  - name: c\npk: incident\n")
    specs, pk = ft.load_specs(str(path))
    assert pk == ["incident"] and specs[0] == ft.FeatureSpec("a", "cat", ("b",), False) and specs[1].type == "float"


def test_dictionary(spark):
    data = [(y, c, t, c == "9A1") for y, c, t in [(2013, "17A2", True), (2013, "17A2", True), (2014, "9A1", False), (2013, "99X", True), (2015, "17A2", False), (2015, "9A1", True), (2015, "1B", True)]]
    df = spark.createDataFrame(data, "time_year int, dispatch_code string, trns_to_hosp boolean, m_required boolean")
    df = df.withColumn("code_type", F.regexp_extract("dispatch_code", r"^\d+", 0)).withColumns({"code_level": F.lit("A"), "code_rest": F.lit("1")})
    d = dictionary.dispatch_dictionary(df)
    assert rows(d, "dispatch_code", "mt_required", "mt_suggested") == [("17A2", False, True), ("9A1", True, True)]
    e = dictionary.effects(d)
    assert rows(e["changes"], "dispatch_code") == [("17A2",)]
    assert e["increase"].first()["dispatch_increase"] == 1.0
    assert e["confusion_change"].first().asDict() == {"tp": 0.0, "fn": 0.0, "fp": 1.0, "tn": -1.0}


def test_one_hot_keeps_train_levels(spark):
    train = spark.createDataFrame([("a", "1", 2013), ("b", "2", 2014), (None, "1", 2013), ("c", "1", 2015)], "x string, code_type string, time_year int")
    tr, te = training.sample_incidents(train, ["x", "code_type"])
    assert tr.columns == te.columns == ["code_type", "time_year", "x_is_b", "x_is_c"]
    assert rows(tr, "x_is_b", "x_is_c") == [(0, 0), (0, 0), (1, 0)] and rows(te, "x_is_b", "x_is_c") == [(0, 1)]


@pytest.mark.parametrize("model", ["LINEAR", "RIDGE", "LASSO", "ELNET"])
def test_group_models_against_numpy(spark, model):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2))
    y = x @ np.array([2.0, -1.0]) + 3 + rng.normal(size=60) * 0.1
    df = spark.createDataFrame([("g", float(a), float(b), float(c)) for (a, b), c in zip(x, y)] + [("h", 1.0, 1.0, 2.0)], "g string, a double, b double, y double")
    got = m.fit_per_group(df, "g", "y", ["a", "b"], model, 0.1, 0.5).where("g = 'g'").first()
    z = (x - x.mean(0)) / x.std(0)
    w, r = np.array(got["coefficients"]), y - y.mean()
    if model == "LINEAR":
        assert w == pytest.approx(np.linalg.lstsq(z, r, rcond=None)[0])
    elif model == "RIDGE":
        assert w == pytest.approx(np.linalg.solve(z.T @ z + 0.1 * np.eye(2), z.T @ r))
    else:  # the optimum beats its neighbours
        l1 = 1.0 if model == "LASSO" else 0.5
        loss = lambda v: ((r - z @ v) ** 2).mean() / 2 + 0.1 * (l1 * np.abs(v).sum() + (1 - l1) * (v @ v) / 2)
        assert all(loss(w) <= loss(w + d) for d in np.vstack([np.eye(2), -np.eye(2)]) * 1e-3)
    pred = m.predict_per_group(df, m.fit_per_group(df, "g", "y", ["a", "b"]), "g", ["a", "b"])
    assert pred.where("g = 'h'").first()["pred"] == pytest.approx(2.0)


def test_classifiers_order_scores(spark):
    df = spark.createDataFrame([(i, i % 10 >= 5, float(i % 10), float(i % 3)) for i in range(200)], "id int, y boolean, a double, b double")
    from callgrid.operators.scoring import metrics_at_k

    for name, params in (("LR", {"C": 1.0}), ("DT", {"max_depth": 3}), ("NB", {}), ("SVM", {}), ("AB", {"n_estimators": 3}), ("RF", {"n_estimators": 3}), ("GB", {"n_estimators": 2, "max_depth": 2})):
        scores = m.fit_score(df, df, "y", "id", ["a", "b"], name, **params)
        tested = scores.where("split = 'test'").join(df, "id")
        assert metrics_at_k(tested, "y", "score", [0.3]).first()["auc"] > 0.95, name


def test_expand_grid():
    runs = m.expand_grid(["LR", "RF"], None, {"high": [], "medium": [], "low": []})
    assert len(runs) == (8 + 48) * 3  # without depths beyond the limit
    assert len(m.expand_grid(["LASSO", "LINEAR"], m.REGRESSOR_GRID)) == 5


def test_levels_are_never_cut(spark):
    with pytest.raises(ValueError):
        m.levels_of(spark.range(50).withColumnRenamed("id", "c"), "c", most=10)


def test_csv_reading(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("My Key,Value\n1,x\n2,y\n(2 rows affected),\n")
    (tmp_path / "in" / "b.csv").write_text("My Key,Value\n3,z\n(1 row affected),\n")
    path = str(tmp_path / "in")
    assert rd.read_csv(spark, path).columns == ["my_key", "value"]
    got = rd.read_csv_trimmed(spark, path, "my_key int, value string")
    assert rows(got) == [(1, "x"), (2, "y"), (3, "z")]
    first = rd.read_csv_trimmed(spark, str(tmp_path / "in" / "a.csv"), "my_key int, value string", first=1)
    assert rows(first) == [(1, "x")]
    assert rd.read_dictionary(spark, path).schema["my_key"].dataType.simpleString() == "string"


def test_footer_of_a_split_file(spark, tmp_path):
    """The last line is found although the file is read in many parts."""
    path = tmp_path / "long.txt"
    path.write_text("head\n" + "".join(f"{i},{'x' * 50}\n" for i in range(5000)) + "foot\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = rd.read_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 5
        got = rd.parse_lines(rd.drop_lines(lines, 1, 1), "i int, x string")
        assert got.agg(F.count("i"), F.sum("i")).first() == (5000, 5000 * 4999 // 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    wr.write_table(df, path, pk="id")
    with pytest.raises(Exception):
        wr.write_table(df, path)
    wr.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        wr.write_table(df.union(df), path, "replace", pk="id")
    wr.export_csv(df, str(tmp_path / "c"))
    assert rd.read_csv(spark, str(tmp_path / "c"), sep="|").count() == 3


def test_catalog_copy(spark, tmp_path):
    spark.sql(f"create database if not exists raw_t location '{tmp_path}/raw'")
    spark.sql(f"create database if not exists clean_t location '{tmp_path}/clean'")
    try:
        wr.save_table(spark.range(2), "raw_t.Mixed", "replace", pk="id")
        assert wr.copy_table(spark, "Mixed", "raw_t", "clean_t") == "clean_t.mixed"
        assert wr.copy_table(spark, "Mixed", "raw_t", "clean_t") is None
        assert rd.read_table(spark, "mixed", "clean_t").count() == 2
        wr.save_table(spark.range(9), "clean_t.b", "replace", bucket_by=(2, "id"))
        assert rd.read_table(spark, "clean_t.b").count() == 9
    finally:
        spark.sql("drop database raw_t cascade")
        spark.sql("drop database clean_t cascade")


def test_streaming_equals_batch(spark, tmp_path):
    from callgrid.operators.aggregates import hourly_demand

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = events.select(F.col("ts").alias("t"), (F.col("user_id") % 3).alias("g"), (F.col("event_type") == "view").alias("y"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    q = hourly_demand_stream(stream, "t", "g", ["y"]).writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
    q = q.outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = hourly_demand(df, "t", "g", ["y"])
    last = df.agg((F.max("t").cast("timestamp") - F.expr("interval 3 hours")).alias("m")).first()["m"]
    closed = batch.where(F.col("time_created") + F.expr("interval 1 hour") <= F.lit(last))
    got = spark.read.parquet(out)
    missing = closed.join(got, ["time_created", "g", "total_incidents", "y"], "left_anti")
    assert got.count() > 0 and missing.count() == 0


def test_moments_of_many_terms_equal_those_of_few(spark):
    """Means far from 0 and small spreads: sums of squares around 0 would lose them."""
    data = [(i % 3 if i % 3 else None, [1e8 + (i * k * 37 % 101) for k in range(1, 6)]) for i in range(300)]
    df = spark.createDataFrame(data, "g int, __t array<double>").repartition(7)
    pairs = [(i, j) for i in range(5) for j in range(i + 1)]
    few, many = ({r["g"]: r for r in f(df, ["g"], pairs).collect()} for f in (m._moments_of_few, m._moments_of_many))
    assert set(few) == set(many) == {None, 1, 2}
    for g, a in few.items():
        assert a["rows"] == many[g]["rows"] and a["__avg"] == pytest.approx(many[g]["__avg"])
        assert a["__cov"] == pytest.approx(many[g]["__cov"], rel=1e-6, abs=1e-4)
    assert m._moments_of_many(df.limit(0), ["g"], pairs).collect() == []


def test_demand_features_read_the_base_few_times(spark):
    from callgrid.catalog import QUERIES

    plan = QUERIES["demand_feature_table"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 20


def test_least_angle_path_against_descent():
    """Along the whole path the lasso's conditions hold; without it the end is least squares; determined features stay out."""
    import numpy as np

    rng = np.random.default_rng(5)
    for trial in range(30):
        x = rng.normal(size=(50, 6)) @ rng.normal(size=(6, 6))
        if trial % 3 == 0:
            x[:, 5] = x[:, 0]
        x = (x - x.mean(0)) / x.std(0)
        y = x @ np.array([3.0, -2, 0, 0, 1, 0]) + rng.normal(size=50)
        q, r = x.T @ x / 50, x.T @ (y - y.mean()) / 50
        for stop in (0.0, 0.05, 0.3, 1.0, 100.0):
            w = m.least_angle_path(q, r, stop, lasso=True)
            c = r - q @ w
            assert np.abs(c).max() <= stop + 1e-8 and np.allclose(c[w != 0], stop * np.sign(w[w != 0]), atol=1e-8)
        assert np.allclose(q @ m.least_angle_path(q, r), r, atol=1e-8)
    assert m.least_angle_path(np.zeros((0, 0)), np.zeros(0)).tolist() == []
    assert m.least_angle_path(np.eye(2), np.zeros(2)).tolist() == [0.0, 0.0]


def test_evidence_weights_do_not_depend_on_units():
    import numpy as np

    q, r = np.array([[1.0, 0.3], [0.3, 1.0]]), np.array([0.5, -0.2])
    w = m.evidence_weights(q, r, 1.0, 200)
    assert np.allclose(m.evidence_weights(q, r * 1e4, 1e8, 200), w * 1e4)
    assert 0 < abs(w[0]) < abs(np.linalg.solve(q, r)[0]) and m.evidence_weights(q, r * 0, 0.0, 200).tolist() == [0.0, 0.0]


def test_real_adaboost(spark):
    """Cuts from bins agree with a plain run over rows; the margin written every few rounds changes nothing."""
    import math

    from callgrid.operators.boosting import RealAdaBoost, best_cut
    from pyspark.ml.feature import VectorAssembler

    data = [(i, (i * 7 % 13 + i % 5 > 9), float(i % 5), float(i * 7 % 13)) for i in range(120)]
    df = spark.createDataFrame(data, "id int, y boolean, a double, b double")
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.withColumn("label", F.col("y").cast("double")))
    often, rarely = (RealAdaBoost(7, every=k).fit(ready) for k in (2, 100))
    assert len(often.stumps) == 7 and [s[:2] for s in often.stumps] == [s[:2] for s in rarely.stumps]
    got = {r["id"]: r["score"] for r in often.transform(ready).collect()}
    weight, margin = [1.0] * 120, [0.0] * 120
    for _ in range(7):
        sums = {}
        for (_, y, *x), w in zip(data, weight, strict=True):
            for f, v in enumerate(x):
                sums.setdefault((f, int(v)), [0.0, 0.0])[y] += w
        f, cut, left, right = best_cut(sums)
        margin = [m_ + (left if row[2 + f] <= cut else right) for m_, row in zip(margin, data, strict=True)]
        weight = [math.exp(-(row[1] - 0.5) * m_) for m_, row in zip(margin, data, strict=True)]
    assert got == pytest.approx({row[0]: 1 / (1 + math.exp(-m_ / 7)) for m_, row in zip(margin, data, strict=True)})
    assert best_cut({(0, 0): [3.0, 1.0]})[2:] == pytest.approx((-math.log(3), -math.log(3)))
    with pytest.raises(ValueError):
        RealAdaBoost(2).fit(ready.limit(0))


def test_grid_in_parallel_equals_one_by_one(spark):
    df = spark.createDataFrame([(i, i % 10 >= 5, float(i % 10), str(i % 4)) for i in range(200)], "id int, y boolean, a double, code_type string")
    grid = {"LR": {"penalty": ["l2"], "C": [0.1, 1.0]}, "KNN": {"n_neighbors": [1, 5], "weights": ["uniform"]}}
    run = lambda n: training.run_grid(df, df, "y", "id", ["a"], ["LR", "KNN"], {"high": ["0", "1"], "low": ["2"]}, grid=grid, workers=n).collect()
    one, many = run(1), run(4)
    assert one == many and len({(r["model"], r["params"], r["bucket"]) for r in one}) == 8

import numpy as np
import pytest
from conftest import rows

from orderloom.operators import regression

SCHEMA = "country string, pop_2022 double, pop_2023 double, continent string, region string, pop_change double"
DATA = [
    ("b", 10.0, 11.0, "X", "r1", 10.0),
    ("a", 20.0, 21.0, "X", "r2", 5.0),
    ("c", 10.0, 9.0, "Y", "r1", -10.0),
    ("d", None, 9.0, "Y", None, None),
    ("e", 5.0, 6.0, "Z", "r3", 20.0),
    ("f", 5.0, None, "W", "r3", None),
]


def least_squares(data):
    data = [d for d in data if d[5] is not None]
    levels = sorted({d[3] for d in data if d[3] is not None})
    x = np.array([[float(d[3] == v) for v in levels] for d in data])
    y = np.array([d[5] for d in data])
    coef = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    base = y.mean() - x.mean(0) @ coef
    r = y - (x @ coef + base)
    scores = 1 - (r @ r) / ((y - y.mean()) ** 2).sum(), np.sqrt((r @ r) / len(y)), abs(r).mean()
    return dict(zip(levels, coef)), base, scores, len(y)


@pytest.mark.parametrize("extra", [[], [("g", 1.0, 2.0, None, "r", 7.0), ("h", 1.0, 2.0, None, "r", 8.0)]])
def test_model_equals_least_squares(spark, extra):
    data = DATA + extra
    got = regression.change_model(spark.createDataFrame(data, SCHEMA)).collect()
    coef, base, (r2, rmse, mae), n = least_squares(data)
    assert {r["continent"] for r in got} == set(coef)
    for r in got:
        assert r["feature"] == f"continent_{r['continent']}"
        assert r["coefficient"] == pytest.approx(coef[r["continent"]], abs=1e-9)
        assert (r["intercept"], r["n_samples"]) == (pytest.approx(base, abs=1e-4), n)
        assert (r["r2"], r["rmse"], r["mae"]) == (
            pytest.approx(r2, abs=1e-4),
            pytest.approx(rmse, abs=1e-4),
            pytest.approx(mae, abs=1e-4),
        )


def test_sums_keep_groups_of_nulls(spark):
    stats = spark.createDataFrame([*DATA, ("z", 1.0, 1.0, None, "r", 1.0)], SCHEMA)
    out = {r["continent"]: r for r in regression.continent_stats(stats, regression.change_model(stats)).collect()}
    assert set(out) == {"X", "Y", "Z", "W"}
    assert (out["W"]["pop_change"], out["W"]["pop_2023"], out["W"]["pop_change_factor"]) == (0.0, 0.0, None)
    assert out["X"]["pop_2022"] == 30.0 and "country" not in out["X"].asDict()


def test_texts_come_as_parts(spark):
    stats = spark.createDataFrame([*DATA, ("z", 1.0, 1.0, None, "r", 1.0)], SCHEMA)
    parts = rows(regression.text_parts(stats, "continent").where("column_name = 'country'").select("continent", "position", "part"))
    assert parts == [("W", 0, "f"), ("X", 0, "a"), ("X", 1, "b"), ("Y", 0, "c"), ("Y", 1, "d"), ("Z", 0, "e")]


def test_a_large_group_of_texts(spark):
    big = spark.range(6000).selectExpr("'k' as g", "lpad(id * 37 % 6000, 5, '0') as t", "id as n")
    parts = regression.text_parts(big, "g").orderBy("position").collect()
    assert [p["position"] for p in parts] == list(range(6000))
    assert [p["part"] for p in parts] == sorted(p["part"] for p in parts)


def test_spoilt_cells_are_named(spark):
    cells = spark.createDataFrame(
        [("A", "1,0", "x", "", "c", "r", 1), ("B", None, " 5 ", "", "c", "r", 2), ("C", "", "1e", "", "c", "r", 3)],
        "a string, b string, c string, d string, e string, f string, id int",
    )
    assert rows(regression.bad_numbers(cells, ["id"])) == [(1, "pop_2023", "x"), (3, "pop_2022", ""), (3, "pop_2023", "1e")]


def test_cells_become_the_country_table(spark):
    cells = spark.createDataFrame(
        [("A", "1,000", "1,100", "x", "Asia", "East"), ("B", "n/a", "5", "x", "Asia", "West"), ("C", "0", "5", "x", "Asia", "West")],
        "c1 string, c2 string, c3 string, c4 string, c5 string, c6 string",
    )
    got = regression.country_stats(cells)
    assert got.columns == ["country", "pop_2022", "pop_2023", "continent", "region", "pop_change"]
    assert rows(got.select("country", "pop_2022", "pop_2023")) == [("A", 1000.0, 1100.0), ("B", None, 5.0), ("C", 0.0, 5.0)]
    change = dict(rows(got.select("country", "pop_change")))
    assert change["A"] == pytest.approx(10.0) and change["B"] is None and change["C"] is None


def test_one_hot_levels(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, c string")
    assert rows(regression.one_hot(df, "c", ["x", "y"])) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    assert regression.one_hot(df, "c", ["x", "y"]).columns == ["id", "c_x", "c_y"]
    assert rows(regression.one_hot_rows(df, "c")) == [(1, "c_x", 1), (2, "c_y", 1)]


def test_thousands_of_levels(spark):
    df = spark.range(5000).selectExpr("id", "concat('l', id) as c")
    assert regression.one_hot_rows(df, "c").select("feature").distinct().count() == 5000

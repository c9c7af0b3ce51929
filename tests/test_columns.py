import hashlib

import pytest
from pyspark.sql import functions as F

from stintlake.functions import columns as C
from stintlake.functions import fixed_values as fv


def one(spark, expr, **values):
    types = {str: "string", int: "bigint", float: "double", bool: "boolean"}
    cols = []
    for name, v in values.items():
        cols.append(F.lit(v).cast(types.get(type(v), "string")).alias(name))
    return spark.range(1).select(*cols).select(expr).first()[0]


@pytest.mark.parametrize(
    "name,category",
    [
        ("Race", "Race"), ("Sprint Qualifying", "Qualifying"), ("Sprint Race", "Race"),
        ("FP1", "Practice"), ("Practice 2", "Practice"), ("Sprint", "Sprint"),
        ("Test Day", "Other"), (None, "Other"), ("QUALIFYING", "Qualifying"),
    ],
)
def test_session_category(spark, name, category):
    assert one(spark, C.session_category("n"), n=name) == category


@pytest.mark.parametrize(
    "team,category",
    [
        ("Oracle Red Bull Racing", "Red Bull Racing"), ("Red Bull RB", "RB"),
        ("Visa Cash App RB", "RB"), ("Racing Bulls", "RB"), ("red bull racing bulls", "RB"),
        ("Alfa Romeo Sauber", "Alfa Romeo"), ("Kick Sauber", "Sauber"),
        ("SCUDERIA ferrari", "Ferrari"), ("MoneyGram Haas", "Haas F1 Team"),
        ("Aston Martin Aramco", "Aston Martin"), ("Scuderia AlphaTauri", "AlphaTauri"),
        ("Andretti", "Other"), (None, "Other"),
    ],
)
def test_team_category(spark, team, category):
    assert one(spark, C.team_category("t"), t=team) == category


@pytest.mark.parametrize(
    "duration,pit,valid",
    [
        (None, False, False), (9.999, False, False), (10.0, False, True), (300.0, None, True),
        (300.001, False, False), (80.0, True, False), (80.0, False, True),
        (float("nan"), False, False),
    ],
)
def test_valid_lap(spark, duration, pit, valid):
    d = F.lit(duration).cast("double")
    p = F.lit(pit).cast("boolean")
    assert spark.range(1).select(C.is_valid_lap(d, p)).first()[0] is valid


@pytest.mark.parametrize(
    "sectors,label", [((1, 2, 3), "Complete"), ((None, None, None), "No Sectors"), ((1, None, 3), "Partial")]
)
def test_sector_completeness(spark, sectors, label):
    cols = [F.lit(s).cast("double") for s in sectors]
    assert spark.range(1).select(C.sector_completeness(*cols)).first()[0] == label


def test_surrogate_key_is_md5_of_joined_parts(spark):
    want = hashlib.md5(b"9158-1-12").hexdigest()
    assert one(spark, C.surrogate_key("a", "b", "c"), a=9158, b=1, c=12) == want
    null_first = one(spark, C.surrogate_key("a", "b"), a=None, b="x")
    assert null_first != one(spark, C.surrogate_key("a", "b"), a="", b="x")


def test_times(spark):
    assert one(spark, C.minutes_between("a", "b"), a="2024-03-02T15:00:00+00:00", b="2024-03-02T17:30:30+00:00") == 150.5
    assert one(spark, C.minutes_between("a", "b"), a="2024-03-02T15:00:00+02:00", b="2024-03-02T15:00:00+00:00") == 120.0
    assert one(spark, C.minutes_between("a", "b"), a="not a date", b="2024-03-02T15:00:00") is None
    assert one(spark, C.parse_time("a").cast("string"), a="2023-09-15T09:30:05.259000+00:00") == "2023-09-15 09:30:05.259"
    parts = spark.range(1).select(*[c.alias(n) for n, c in C.calendar(F.lit("2024-03-03T15:00:00")).items()]).first()
    assert str(parts["session_date"]) == "2024-03-03"
    assert (parts["session_day_of_week"], parts["session_quarter"], parts["session_week_of_year"]) == (1, 1, 9)


def test_file_key_and_day(spark):
    key = C.file_key(F.lit("laps"), C.day_of("d"), "l", "s")
    got = one(spark, key, d="2024-05-04T10:00:00", l="Miami / Gardens", s="Sprint Race")
    assert got == "laps_2024-05-04_Miami___Gardens_Sprint_Race"
    assert one(spark, key, d="soon", l=None, s="A/B C") == "laps_unknown_Unknown_A/B_C"
    assert one(spark, C.day_of("d"), d=None) == "unknown"


def test_statuses(spark):
    assert one(spark, C.count_status("a", "e"), a=90, e=100) == fv.COUNT_PASS
    assert one(spark, C.count_status("a", "e"), a=89, e=100) == fv.COUNT_LOW
    assert one(spark, C.count_status("a", "e"), a=0, e=100) == fv.COUNT_EMPTY
    assert one(spark, C.equal_status("a", "e"), a=1, e=1) == fv.EQUAL_PASS
    assert one(spark, C.duration_check("c", "m"), c="Race", m=120.0) == "CHECK"
    assert one(spark, C.duration_check("c", "m"), c="Race", m=121.0) == "OK"
    assert one(spark, C.duration_check("c", "m"), c="Sprint", m=999.0) == "CHECK"
    assert one(spark, C.lap_speed_class("d"), d=59.9) == fv.VERY_FAST
    assert one(spark, C.lap_speed_class("d"), d=60.0) == "NORMAL"
    assert one(spark, C.lap_speed_class("d"), d=300.5) == fv.VERY_SLOW


def test_mask_and_division(spark):
    assert one(spark, C.mask_tail("t"), t="someone@example.org") == "som***@***.com"
    assert one(spark, C.percent("a", "b"), a=1, b=0) is None
    assert one(spark, C.percent("a", "b"), a=1, b=3) == 33.33


def test_mean_does_not_depend_on_order(spark):
    values = [80.123, 81.4, 79.999, None, 300.0, 10.0]
    for n in (1, 3, 5):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(n)
        assert df.agg(C.mean("v")).first()[0] == 551.522 / 5
    assert spark.createDataFrame([], "v double").agg(C.mean("v")).first()[0] is None

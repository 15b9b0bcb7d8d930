import datetime as dt

from pyspark.sql import functions as F

from chronoweave.functions import calendar as cal
from chronoweave.functions import session, text
from chronoweave.functions.text import COMMANDS, command_flags, error_json, flag_set, sql_text
from chronoweave.sources.generators import date_dimension, interval_dimension

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_iso_weeks_around_new_year(spark):
    rows = {r["date"]: r for r in date_dimension(spark, D(2020, 12, 28), D(2021, 1, 4)).collect()}
    assert (rows[D(2021, 1, 3)]["year52"], rows[D(2021, 1, 3)]["week"]) == (2020, 53)
    assert rows[D(2021, 1, 3)]["year_week_short"] == "2020W53"
    assert rows[D(2021, 1, 4)]["year_week"] == 202101
    assert rows[D(2021, 1, 4)]["weeks_2000"] - rows[D(2021, 1, 3)]["weeks_2000"] == 1


def test_continuous_week_before_its_zero(spark):
    assert one(spark, cal.continuous_week(F.lit(D(2000, 1, 3)))) == 0
    assert one(spark, cal.continuous_week(F.lit(D(2000, 1, 2)))) == -1
    assert one(spark, cal.continuous_week(F.lit(D(1999, 12, 26)))) == -2


def test_year_bounds(spark):
    d = F.lit(D(2024, 2, 29))
    assert one(spark, cal.first_day_previous_year(d)) == D(2023, 1, 1)
    assert one(spark, cal.last_day_next_year(d)) == D(2025, 12, 31)
    assert one(spark, cal.last_day_previous_year(d)) == D(2023, 12, 31)
    assert one(spark, cal.first_day_current_year_week(F.lit(D(2026, 7, 1)))) == D(2025, 12, 29)
    today = one(spark, F.current_date())
    assert one(spark, cal.first_day_current_year()) == D(today.year, 1, 1)
    assert one(spark, cal.first_day_next_year(F.lit(None).cast("date"))) == D(today.year + 1, 1, 1)


def test_moves_without_counterpart_are_null(spark):
    assert one(spark, cal.same_week_in_year(F.lit(D(2020, 12, 30)), F.lit(1))) is None
    assert one(spark, cal.same_week_in_year(F.lit(D(2020, 3, 4)), F.lit(1))) == D(2021, 3, 10)
    assert one(spark, cal.same_day_in_year(F.lit(D(2020, 2, 29)), F.lit(1))) is None
    assert one(spark, cal.same_day_in_year(F.lit(D(2020, 2, 29)), F.lit(4))) == D(2024, 2, 29)
    assert one(spark, cal.day_of_year_in(F.lit(2023), F.lit(366))) is None


def test_intervals(spark):
    rows = interval_dimension(spark).orderBy("interval_id").collect()
    assert len(rows) == 96
    assert (rows[95]["time_start"], rows[95]["time_end_exclusive"]) == ("23:45", "00:00")
    assert rows[2]["time_halfhour"] == "30-59" and rows[3]["time_halfhour"] is None
    assert rows[37]["time_start_sec"] == "9:15:00" and rows[37]["time_end_sec"] == "9:29:59"
    assert str(rows[4]["time_end_datetime"]) == "1899-12-30 01:14:59"


def test_string_spaces_keeps_the_ends(spark):
    assert one(spark, text.string_spaces(F.lit(" a\t\tb\r\n c  "))) == " a b c "


def test_sql_text():
    assert text.sql_text("[date] between '[x]' and S.value1") == "`date` between '[x]' and value1"
    assert text.sql_text("A.domain='S.x' and DATA.site_id=1") == "domain='S.x' and site_id=1"
    assert text.sql_text("data.v > 1.5 and xs.v = 2") == "v > 1.5 and xs.v = 2"


def test_field_list():
    assert text.field_list("[value1], round(a, 2),'x,y'") == ["`value1`", "round(a, 2)", "'x,y'"]
    assert text.field_list("") == []


def test_flags_are_whole_words(spark):
    assert "NOSCHEDULE" not in text.flag_set("-NO_SCHEDULE")
    assert text.flag_set("-print -NoDelta") == {"PRINT", "NODELTA"}
    flags = text.command_flags(F.lit("-NOINTRADAY\t-sumfields"))
    assert not one(spark, flags["INTRADAY"])
    assert one(spark, flags["NOINTRADAY"]) and one(spark, flags["SUMFIELDS"])


def test_numbers_from_text():
    assert text.to_int(" 7 ") == 7 and text.to_int("") == 0 and text.to_int("x") == 0
    assert text.to_scale("1,5") == 1.5 and text.to_scale("0") == 1.0 and text.to_scale("") == 1.0


def test_sql_functions_equal_the_column_functions(spark):
    session.register_functions(spark, dt.datetime(2024, 3, 15, 12, 0, 0, 5, tzinfo=dt.timezone.utc))
    days = spark.range(800).select(F.date_add(F.lit(D(2019, 11, 1)), F.col("id").cast("int")).alias("d"))
    for name in session.FUNCTIONS:
        if name != "string_spaces":
            same = days.where(F.expr(f"{name}(d)") == getattr(cal, name)(F.col("d"))).count()
            assert same == 800, name
    assert spark.sql("select string_spaces(' a\\t\\n b ') as x").first()["x"] == " a b "
    assert one(spark, F.expr("date_format(getdate(), 'yyyy-MM-dd HH:mm:ss.SSSSSS')")) == "2024-03-15 12:00:00.000005"
    assert one(spark, F.expr("first_day_next_year()")) == one(spark, cal.first_day_next_year())


def test_sql_text_leaves_elements_structs_and_quoted_text_alone():
    assert sql_text("split(x,'-')[0] = 'a'") == "split(x,'-')[0] = 'a'"
    assert sql_text("props['k'] = 1 and [my name] > 2") == "props['k'] = 1 and `my name` > 2"
    assert sql_text('name = "S.A. Corp"') == 'name = "S.A. Corp"'
    assert sql_text("S.[year] = 1 and F.value1 > row.s.id") == "`year` = 1 and value1 > row.s.id"
    assert sql_text("data.value > 1", ["data"]) == "data.value > 1"


def test_flags_of_columns_and_of_texts_agree(spark):
    for text in ("-LOG_QUERIES", "-log_import --PRINT", "NODAY -NODAYS", "-LOG_QUERY -DATADAY"):
        row = spark.range(1).select(*[c.alias(k) for k, c in command_flags(F.lit(text)).items()]).first()
        assert {k for k, held in row.asDict().items() if held} == flag_set(text) & set(COMMANDS)


def test_error_messages_are_whole():
    assert len(error_json(ValueError("x" * 5000))["Message"]) == 5000

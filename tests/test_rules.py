from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from atende.functions import privacy, rules
from atende.functions.casts import digits, fill_defaults, lower_text, safe_cast, upper_text
from atende.operators.cdc import first_reason, row_hash

T = datetime(2024, 1, 1, 10, 0)


def value(spark, expr, **cols):
    """Evaluate one expression over one row of typed literals."""
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in cols.items()])
    return row.select(expr.alias("x")).first()["x"]


def null(kind):
    return F.lit(None).cast(kind)


@pytest.mark.parametrize(
    "seconds, end, expected",
    [(300, datetime(2024, 1, 1, 10, 5), 1), (0, datetime(2024, 1, 1, 10, 5), 0),
     (300, datetime(2024, 1, 1, 9, 59), 0), (-10, datetime(2024, 1, 1, 10, 5), 0)],
)
def test_valid_duration(spark, seconds, end, expected):
    assert value(spark, rules.flag_valid_duration("s", "a", "b"), s=seconds, a=T, b=end) == expected


def test_valid_duration_without_end(spark):
    assert value(spark, rules.flag_valid_duration("s", "a", "b"), s=300, a=T, b=null("timestamp")) == 0


def test_complete(spark):
    none = null("timestamp")
    for a, b, expected in [(T, T, 1), (T, none, 0), (none, T, 0), (none, none, 0)]:
        assert value(spark, rules.flag_complete("a", "b"), a=a, b=b) == expected


@pytest.mark.parametrize("seconds, minutes", [(60, 1.0), (90, 1.5), (300, 5.0), (0, 0.0), (61, 1.02), (3600, 60.0)])
def test_minutes(spark, seconds, minutes):
    assert value(spark, rules.minutes_from_seconds("s"), s=seconds) == minutes


def test_row_hash(spark):
    def h(*vals):
        return value(spark, row_hash([f"c{i}" for i in range(len(vals))]), **{f"c{i}": v for i, v in enumerate(vals)})

    base = h(1, "ATENDIDA", 300)
    assert base == h(1, "ATENDIDA", 300) and len(base) == 32
    assert base != h(1, "ABANDONADA", 300) and base != h(1, "ATENDIDA", 301)
    assert h(1, null("string")) == h(1, "")


def test_first_reason_wins(spark):
    checks = [(F.col("a").isNull(), "a_nulo"), (F.col("b").isNull(), "b_nulo"), (F.col("s") < 0, "negativa")]
    nothing = null("int")
    cases = [((nothing, nothing, -1), "a_nulo"), ((1, nothing, -1), "b_nulo"), ((1, 1, -1), "negativa"), ((1, 1, 5), None)]
    for (a, b, s), expected in cases:
        assert value(spark, first_reason(checks), a=a, b=b, s=s) == expected


@pytest.mark.parametrize(
    "text, masked",
    [("12345678901", "123*****01"), ("98765432100", "987*****00"), ("00011122233", "000*****33"), ("", "")],
)
def test_mask_document(spark, text, masked):
    assert value(spark, privacy.mask_document("c"), c=text) == masked


def test_other_masks(spark):
    assert value(spark, privacy.mask_email("c"), c="operador@empresa.com.br") == "***@empresa.com.br"
    assert value(spark, privacy.mask_email("c"), c="sem arroba") == ""
    assert value(spark, privacy.mask_phone("c"), c="11987654321") == "******4321"
    assert value(spark, privacy.mask_postal_code("c"), c="01310100") == "01310***"
    assert value(spark, privacy.mask_postal_code("c"), c="123") == ""
    assert value(spark, privacy.mask_login("c"), c="joana@x.com") == "joa***"
    for mask in (privacy.mask_document, privacy.mask_email, privacy.mask_phone, privacy.mask_postal_code, privacy.mask_login):
        assert value(spark, mask("c"), c=null("string")) == ""


def test_redaction_keeps_length_only(spark):
    assert value(spark, privacy.text_length("c"), c="olá") == 3
    assert value(spark, privacy.text_length("c"), c=null("string")) == 0
    assert value(spark, privacy.has_text("c"), c="") == 0


@pytest.mark.parametrize("minutes, inside", [(0, 1), (240, 1), (479, 1), (480, 1), (480.1, 1), (480.9, 1), (481, 0), (1440, 0)])
def test_sla_on_whole_minutes(spark, minutes, inside):
    assert value(spark, rules.flag_within_sla("m"), m=float(minutes)) == inside


@pytest.mark.parametrize(
    "score, band, passed",
    [(10, "EXCELENTE", 1), (9, "EXCELENTE", 1), (8.9, "BOM", 1), (8, "BOM", 1), (7, "BOM", 1), (6.9, "REGULAR", 0),
     (6, "REGULAR", 0), (5, "REGULAR", 0), (4.9, "RUIM", 0), (4, "RUIM", 0), (3, "RUIM", 0), (2.9, "CRITICO", 0),
     (2, "CRITICO", 0), (1, "CRITICO", 0)],
)
def test_score_bands(spark, score, band, passed):
    assert value(spark, rules.band_score("n"), n=float(score)) == band
    assert value(spark, rules.flag_passed("n"), n=float(score)) == passed


def test_score_band_of_null(spark):
    assert value(spark, rules.band_score("n"), n=null("double")) == "DESCONHECIDO"


def test_tenure_and_wait_borders(spark):
    for days, band in [(89, "ATE_3_MESES"), (90, "3_A_6_MESES"), (364, "6_A_12_MESES"), (729, "1_A_2_ANOS"), (730, "ACIMA_2_ANOS")]:
        assert value(spark, rules.band_tenure("d"), d=days) == band
    for seconds, band in [(30, "ATE_30S"), (31, "31_A_60S"), (120, "61_A_120S"), (121, "ACIMA_120S")]:
        assert value(spark, rules.band_wait("s"), s=seconds) == band


def test_casts_give_null_instead_of_failing(spark):
    assert value(spark, safe_cast("c", "bigint"), c="x1") is None
    assert value(spark, safe_cast("c", "int"), c="99999999999") is None
    assert value(spark, safe_cast("c", "timestamp"), c="2024-13-01 00:00:00") is None
    assert value(spark, safe_cast("c", "date"), c="2024-01-31") == date(2024, 1, 31)
    assert value(spark, safe_cast("c", "date"), c="2024-01-31 10:00:00") is None
    assert value(spark, safe_cast("c", "boolean"), c="talvez") is None


def test_text_cleaning(spark):
    assert value(spark, upper_text("c", "X"), c="  ativa ") == "ATIVA"
    assert value(spark, upper_text("c", "X"), c=null("string")) == "X"
    assert value(spark, lower_text("c"), c=" A@B ") == "a@b"
    assert value(spark, digits("c"), c="(11) 9-8") == "1198"
    assert value(spark, digits("c", keep_plus=True), c="+55 (11)") == "+5511"


def test_fill_defaults_keeps_types(spark):
    df = spark.sql("select cast(null as bigint) a, cast(null as string) b, 5 c")
    out = fill_defaults(df, {"a": -1, "b": "DESCONHECIDO"})
    assert out.dtypes == df.dtypes and tuple(out.first()) == (-1, "DESCONHECIDO", 5)


def test_traffic_light_directions(spark):
    for v, label in [(95.0, "VERDE"), (94.9, "AMARELO"), (84.9, "VERMELHO")]:
        assert value(spark, rules.traffic_light("v", (95, 85)), v=v) == label
    for v, label in [(5.0, "VERDE"), (10.0, "AMARELO"), (10.1, "VERMELHO")]:
        assert value(spark, rules.traffic_light("v", (5, 10), higher_is_better=False), v=v) == label
    assert value(spark, rules.traffic_light("v", (95, 85)), v=null("double")) == "VERMELHO"


def test_pct_and_rounding(spark):
    assert value(spark, rules.pct(F.col("a"), F.col("b")), a=1, b=0) is None
    assert value(spark, rules.pct(F.col("a"), F.col("b")), a=1, b=3) == 33.33
    # 37.185 is stored a little below the border
    assert value(spark, rules.half_up(F.col("v") / F.lit(60.0)), v=2231.1) == 37.19


def test_calendar(spark):
    row = spark.range(1).select(F.lit(date(2024, 12, 25)).alias("d"))
    out = row.select(*[c.alias(n) for n, c in rules.calendar_attributes("d").items()]).first()
    assert (out.nr_dia_semana, out.ds_dia_semana, out.ds_mes, out.ds_trimestre) == (4, "QUARTA", "DEZEMBRO", "Q4")
    assert (out.fl_feriado, out.fl_dia_util, out.fl_fim_de_semana) == (1, 0, 0)

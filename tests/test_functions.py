import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D, fuzzy, money as M, text as T


def one(spark, rows, fn):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_name_keys(spark):
    cases = {
        "The Acme Company Limited": "acme", "ACME & Sons Ltd.": "acme sons", "F M Conway": "fm conway", "F.M. Conway": "fm conway", "A B C Ltd": "abc", "whats.on": "whatson",
        "C.I.C. Works": "works", "Acme.co.uk": "acme", "University of Leeds": "university leeds", "The A Team": "the a team", "": "", "!Brand": "brand", "O'Neill Holdings": "oneill", "Acme.com": "acme",
    }
    assert dict(zip(cases, one(spark, list(cases), T.name_key))) == cases
    assert one(spark, [None], T.name_key) == [""]
    again = one(spark, list(cases.values()), T.name_key)
    assert again == list(cases.values())


def test_match_names(spark):
    cases = {"PAYPAL *acme": "acme", "stk*wp-Acme": "Acme", "Eplatform.co Ebooks": "Eplatform", "St. John": "St. John", "Acme.construction": "Acme.construction", "sumup": "sumup"}
    assert dict(zip(cases, one(spark, list(cases), T.match_name))) == cases


def test_initials(spark):
    assert one(spark, ["fm conway", "fred mathew conway", "bbc", "4 you"], lambda c: T.initials(F.split(c, " "))) == ["fmc", "fmc", "bbc", "you"]


def test_gateway_clean(spark):
    cases = {"PAYPAL *ACME": "ACME", "Acme Ltd and more": "Acme Ltd", "Acme 123456": "Acme", "Acme 123": "Acme 123", "SQ *Shop": "Shop", "1234567": "1234567", "": ""}
    assert dict(zip(cases, one(spark, list(cases), T.gateway_clean))) == cases


def test_supplier_clean(spark):
    cases = {
        "Acme, Limited (UK)": "Acme Ltd", "ACME L.T.D. trading": "ACME Ltd", "what?ever": "whatever", "a&b": "a & b", "wwwAcme": "www.Acme", "www.amazon.co.uk": "Amazon", "@shop": "shop",
        "shop@home": "shop", "Acme T/A Other": "Acme", "Acme [x": "Acme", "Acme P.L.C.": "Acme Plc", "Acme LT": "Acme Ltd",
    }
    assert dict(zip(cases, one(spark, list(cases), lambda c: T.supplier_clean(c)))) == cases


def test_initial_caps(spark):
    assert one(spark, ["acme BBC uk"], lambda c: T.initial_caps(c, ["UK", "BBC"])) == ["Acme BBC UK"]
    assert one(spark, ["BCD ACME o'neil", "  "], T.initial_caps) == ["BCD Acme O'neil", ""]


def test_comparison_key(spark):
    assert one(spark, ["Alzheimer's Society Ltd", "Alzheimers Society", "A & B", "E-penny"], T.comparison_key) == ["ALZHEIMER SOCIETY", "ALZHEIMER SOCIETY", "A AND B", "EPENNY"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("2024-07-15", "15/07/2024"), ("2024-07-15 10:00:00", "15/07/2024"), ("5/7/2024", "05/07/2024"), ("05/07/2024 10:00", "05/07/2024"), ("15/07/49", "15/07/2049"), ("15/07/50", "15/07/1950"),
        ("15.07.2024", "15/07/2024"), ("15-Jul-24", "15/07/2024"), ("15/July/2024", "15/07/2024"), ("15 July 2024", "15/07/2024"), ("15 07 24", "15/07/2024"), ("45678", "21/01/2025"), ("20240715", "15/07/2024"),
        ("31/02/2024", "31/02/2024"), ("32/01/2024", None), ("15-Foo-2024", None), ("", None), (None, None), ("15/07/1800", None),
    ],
)
def test_dates(spark, raw, want):
    assert one(spark, [raw], D.standard_date) == [want]


def test_typed_and_file_dates(spark):
    assert one(spark, ["31/02/2024", "01/03/2024", None], D.month_of) == [None, 3, None]
    names = ["spend_Jan-23.csv", "jun2025.xlsx", "apr24 spend.csv", "2025-Jan.csv", "2024december.csv", "nothing.csv"]
    assert one(spark, names, D.date_in_filename) == ["01/01/2023", "01/06/2025", "01/04/2024", "01/01/2025", "01/12/2024", None]


def test_periods(spark):
    got = one(spark, ["Q4 2021", "Nov to Feb 2023", "May 2020", "Spend 2020", "none", "March 2021 to April 2021"], D.months_covered)
    assert [[str(m)[:7] for m in x] for x in got] == [["2022-01", "2022-02", "2022-03"], ["2022-11", "2022-12", "2023-01", "2023-02"], ["2020-05"], [f"2020-{m:02d}" for m in range(4, 13)] + ["2021-01", "2021-02", "2021-03"], [], ["2021-03", "2021-04"]]


def test_amounts(spark):
    cases = {"£1,234.50": "1234.50", "1 234.50": "1 234.50".replace(" ", ""), "107694 2": "107694.2", "12 345": "12345", "(5)": "(5)", " - ": "-"}
    assert dict(zip(cases, one(spark, list(cases), M.clean_amount))) == cases
    assert one(spark, ["1e3", "1_000", "nan", ".5", "5.", "", None], M.is_number) == [True, False, False, True, True, False, False]


def test_company_numbers(spark):
    assert one(spark, ["see 01234567 or SC123456", "no 123456", "x", None], T.company_numbers) == [["01234567", "SC123456"], ["00123456"], [], []]


def test_scorers():
    assert fuzzy.ratio("abc", "abc") == 100 and fuzzy.lcs("abcde", "ace") == 3 and fuzzy.ratio("", "a") == 0
    assert fuzzy.token_sort_ratio("b a", "a b") == 100 and fuzzy.token_set_ratio("a b", "a b c") == 100
    assert fuzzy.partial_ratio("abc", "xxabcxx") == 100 and fuzzy.weighted_ratio("", "a") == 0
    assert fuzzy.weighted_ratio("acme works", "works acme") == 95


def test_period_pattern(spark):
    samples = [("Spend over £500 March 2021 (CSV 12 KB)", "spend over £500 July 2024", "spend over £500 2024"), ("Q1 2021/22 payments", "Q4 2023/24 Payments", "Q5 2023/24 payments"), ("Quarter one 2021", "quarter three 2022", "quarter three"), ("2020", "2024", "x"), ("Card", "Card", None), (None, "2020", None), ("Spend 2020", "Spend 2020", None)]
    df = spark.createDataFrame(samples, "sample string, good string, bad string").withColumn("p", D.period_pattern(F.col("sample")))
    got = df.select(F.expr("regexp_like(good, concat('^', p, '$'))").alias("good"), F.expr("regexp_like(bad, concat('^', p, '$'))").alias("bad")).collect()
    assert [r.good for r in got] == [True] * 4 + [None] * 3 and [r.bad for r in got] == [False] * 4 + [None] * 3

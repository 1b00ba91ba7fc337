import pytest
from pyspark.errors import SparkRuntimeException

from panelwright.operators import clean, link, reshape
from panelwright.plans import accounts, executives, forecasts, holders, international, linked, market, sheets
from panelwright.sources import read_delimited, run_sql, write_delimited
from tests.conftest import close, rows, table

NAMES = [
    (4077, "QQAA0010", "QQBB0020", 19860101, 19890630),
    (4077, "QQBB0010", "QQBB0020", 19890701, 19981231),
    (4077, "QQBB0020", "QQBB0020", 19990101, 20101231),
    (2, "AAAA0001", "BBBB0002", 19900101, 19941231),
    (2, "BBBB0002", "BBBB0002", 19950101, 20001231),
    (3, None, "CCCC0003", 19900101, 19991231),
]
SECURITIES = [("40779", "01", "QQAA00100"), ("777", "01", "BBBB00029"), ("888", "01C", "QQBB00109")]


def _link_inputs(spark):
    names = table(spark, "permno long, ncusip string, cusip string, namedt int, nameendt int", *NAMES)
    return names, table(spark, "gvkey string, iid string, cusip string", *SECURITIES)


@pytest.mark.parametrize("block", [None, link.YEAR, 3])
def test_link_table(spark, block):
    names, securities = _link_inputs(spark)
    got = link.link_by_history(names, securities, block=block)
    assert rows(got) == [(2, "777", 19900101, 20001231), (4077, "40779", 19860101, 19890630)]


def test_coverage_of_the_two_codes(spark):
    names, securities = _link_inputs(spark)
    by_history, by_current = link.link_by_history(names, securities), link.link_by_current(names, securities)
    assert rows(by_current, "permno", "gvkey") == [(2, "777")]
    assert rows(link.link_coverage(by_history, by_current)) == [(2, "777", 3), (4077, "40779", 1)]


def test_price_cleaning(spark):
    raw = table(
        spark,
        "permno long, date int, ret string, shrcd int, exchcd int, prc double, shrout double, cfacpr double, cfacshr double",
        (1, 20000131, "0.5", 10, 1, -12.5, 1000.0, 2.0, 2.0),
        (1, 20000229, "C", 11, 3, 0.0, 1000.0, 2.0, 2.0),
        (1, 20000331, "0.1", 10, 2, 8.0, 1000.0, 0.0, 2.0),
        (1, 20000331, "0.1", 10, 2, 8.0, 1000.0, 0.0, 2.0),
        (2, 20000331, "0.1", 12, 2, 8.0, 1000.0, 1.0, 2.0),
        (3, 20000331, "0.1", 10, 4, 8.0, 1000.0, 1.0, 2.0),
    )
    got = market.clean_stocks(raw)
    assert rows(got, "date", "ret", "price", "me", "price_adj", "shrout_adj") == [
        (20000131, 0.5, 12.5, 12.5, 6.25, 2000.0),
        (20000229, None, None, None, None, 2000.0),
        (20000331, 0.1, 8.0, 8.0, None, 2000.0),
    ]


def test_ambiguous_years_by_fiscal_or_calendar_year(spark):
    flags = ("C", "INDL", "STD", "D")
    raw = table(
        spark, "gvkey string, datadate int, fyear int, consol string, indfmt string, datafmt string, popsrc string, curcd string",
        ("a", 20000331, 1999, *flags, "USD"), ("a", 20001231, 2000, *flags, "USD"), ("b", 20001231, 2000, *flags, "USD"),
        ("b", 20001231, 2000, *flags, "CAD"), ("c", 20001231, None, *flags, "USD"), ("c", 20001231, 2000, "P", "INDL", "STD", "D", "USD"),
    )
    assert rows(accounts.clean_accounts(raw), "gvkey", "datadate") == [("a", 20000331), ("a", 20001231), ("b", 20001231)]
    by_calendar = raw.selectExpr("*", "datadate div 10000 AS year")
    got = accounts.clean_accounts(by_calendar, ["gvkey", "year"])
    assert rows(got, "gvkey", "datadate") == [("b", 20001231), ("c", 20001231)]


def test_forecast_sample_filters_then_counts(spark):
    data = [("A", 19800100 + i, 1, 1.0) for i in range(3)] + [("A", 19800100, 1, 2.0)]
    data += [("B", 19800100 + i, i % 2, 1.0) for i in range(4)] + [("C", 19800100 + i, 1, None) for i in range(4)]
    raw = table(spark, "ticker string, statpers int, usfirm int, numest double", *data)
    assert {r[0] for r in rows(forecasts.forecast_sample(raw, 3), "ticker")} == {"A"}
    assert forecasts.forecast_sample(raw, 3).count() == 3


def test_holder_counts(spark):
    import datetime as dt

    d1, d2 = dt.date(2005, 3, 31), dt.date(2005, 6, 30)
    raw = table(
        spark, "mgrno long, rdate date, fdate date, typecode int",
        (1, d1, d1, 1), (2, d1, d1, 1), (3, d1, d1, 5), (4, d1, d2, 2), (5, d2, d2, 3), (None, d2, d2, 4),
    )
    cols = ("rdate", "bank", "insurance", "mutual_fund", "advisor", "other", "total")
    assert rows(holders.holder_counts(raw), *cols) == [(d1, 2, None, None, None, 1, 3), (d2, None, None, 1, 0, None, 1)]
    assert rows(holders.holder_counts(raw, "2005-04-01"), "rdate") == [(d2,)]


PEOPLE = [
    ("1", 2000, 1, "FEMALE", "CEO"), ("1", 2000, 2, "FEMALE", None), ("1", 2000, 3, "MALE", None), ("1", 2000, 4, None, None),
    ("1", 2000, 3, "MALE", None), ("2", 2000, 5, "MALE", "CEO"), ("2", 2000, 6, "MALE", None),
]


def test_gender_shares(spark):
    raw = table(spark, "gvkey string, fyear int, execid int, gender string, ceoann string", *PEOPLE)
    close(rows(executives.gender_shares(raw)), [(2000, 1 / 3, 1 / 6)])
    close(rows(executives.gender_shares(raw, "all")), [(2000, 1 / 4, 1 / 8)])


def test_sheets(spark):
    head1, head2 = "GB0000000001 - ASSETS", "GB0000000002 - ASSETS"
    assets = table(spark, f"Code int, `{head1}` double, `{head2}` double", (2000, 1.0, None), (2001, 2.0, 3.0))
    ends = table(spark, f"Code int, `{head1}` string, `{head2}` string", (2000, "12/31", "6/30"), (2001, None, "6"))
    got = sheets.sheet_panel(assets, ends)
    assert rows(got, "isin", "year", "asset", "fmonth") == [
        ("GB0000000001", 2000, 1.0, 12), ("GB0000000001", 2001, 2.0, None),
        ("GB0000000002", 2000, None, 6), ("GB0000000002", 2001, 3.0, 6),
    ]
    firms = table(spark, "firmid int, isin string", (1, "GB1"), (2, "GB2"), (3, "GB3"))
    by_position = sheets.positional_panel(assets, firms)
    assert (3, "GB3", None, None) in rows(by_position, "firmid", "isin", "year", "asset") and by_position.count() == 5
    vendor = table(spark, f"date int, `{head1}` string, `{head2}` string", (2000, "1.5", "#N/A"), (2001, "x", "#N/A"))
    assert sheets.vendor_panel(vendor).count() == 4
    assert rows(sheets.vendor_panel(vendor, drop_unknown=True), "date", "asset") == [(2000, 1.5), (2001, None)]


def test_international_returns(spark):
    def row(iid, day, price, **other):
        base = dict(gvkey="1", iid=iid, datadate=day, tpci="0", prirow="01W", fic="GBR", prccd=price, ajexdi=1.0, trfd=1.0, monthend=0)
        return tuple({**base, **other}.values())

    schema = "gvkey string, iid string, datadate int, tpci string, prirow string, fic string, prccd double, ajexdi double, trfd double, monthend int"
    raw = table(
        spark, schema,
        row("01W", 20200130, 10.0), row("01W", 20200131, 11.0, monthend=1), row("01W", 20200204, 12.0),
        row("01W", 20200131, 11.0, monthend=1), row("01W", 20200228, 22.0, monthend=1), row("02W", 20200203, 5.0, gvkey="2", prirow="02W"),
        row("02W", 20200131, 9.0), row("01W", 20200130, 1.0, tpci="F"), row("01W", 20200430, 44.0, monthend=1),
    )
    issues = international.common_issues(raw, "GBR")
    prices = international.adjusted_prices(issues)
    daily = rows(international.daily_returns(prices, issues).filter("gvkey = '1'"), "datadate", "date_idx", "date_diff", "ret")
    assert rows(international.daily_returns(prices)) == rows(international.daily_returns(prices, issues))
    close(daily, [(20200130, 1, None, None), (20200131, 2, 1, 0.1), (20200204, 4, 2, None), (20200228, 5, 1, 22 / 12 - 1), (20200430, 6, 1, 1.0)])
    monthly = rows(international.monthly_returns(prices), "yyyymm", "month_diff", "ret")
    close(monthly, [(202001, None, None), (202002, 1, 1.0), (202004, 2, None)])


def test_one_to_one_code_merge_refuses_a_repeated_month(spark):
    stock = "permno long, date int, cusip string, shrcd int, exchcd int, prc double, shrout double, ret string"
    stocks = table(spark, stock, (1, 20001229, "AAAA0001", 10, 1, 5.0, 1000.0, "0.1"), (2, 20001229, "BBBB0001", 10, 1, 5.0, 1000.0, "0.1"))
    report = "gvkey string, datadate int, fyear int, cusip string, seq double, ib double, at double"
    reports = table(spark, report, ("7", 20001231, 2000, "AAAA00019", -1.0, 2.0, 3.0), ("7", 20000630, 2000, "AAAA00019", 1.0, 2.0, 3.0))
    got = linked.firm_months_by_code(stocks, reports)
    assert rows(got, "gvkey", "cusip", "yyyymm", "me", "seq") == [("7", "AAAA0001", 200012, 5.0, -1.0)]
    twice = stocks.unionByName(stocks.selectExpr("permno + 5 AS permno", *stocks.columns[1:]))
    with pytest.raises(SparkRuntimeException, match="left side"):
        linked.firm_months_by_code(twice, reports).collect()


def test_delimited_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = table(spark, "Id int, Ret string, Name string", (1, "0.5", "é"), (2, "C", "b"))
    write_delimited(df, path, encoding="ISO-8859-1")
    got = read_delimited(spark, path, "Id int, Ret string, Name string", encoding="ISO-8859-1")
    assert got.columns == ["id", "ret", "name"]
    assert rows(clean.to_number(got, ["ret"])) == [(1, 0.5, "é"), (2, None, "b")]
    # By name, in any order; other columns are not read.
    part = read_delimited(spark, path, "NAME string, id long", encoding="ISO-8859-1")
    assert rows(part) == [("b", 2), ("é", 1)]
    plan = part._jdf.queryExecution().executedPlan().toString().lower()
    assert "readschema: struct<id:bigint,name:string>" in plan
    with pytest.raises(ValueError, match="price"):
        read_delimited(spark, path, "id long, price double")


def test_sql_over_named_tables(spark):
    df = table(spark, "a int", (1,), (2,))
    assert rows(run_sql(spark, "SELECT a FROM {t} WHERE a > 1", t=df)) == [(2,)]


def test_wide_and_long(spark):
    df = table(spark, "id int, a double, b double", (1, 1.0, None))
    long = reshape.to_long(df, ["id"])
    assert rows(long, "variable", "value") == [("a", 1.0), ("b", None)]
    assert rows(reshape.to_wide(long, ["id"], "variable", "value", {"a": "a", "b": "b", "c": "c"})) == [(1, 1.0, None, None)]
    with pytest.raises(ValueError, match="repeated"):
        reshape.to_wide(long.unionByName(long), ["id"], "variable", "value", {"a": "a"})


def test_no_category_is_lost_when_widening(spark):
    long = table(spark, "id int, kind string, v int", (1, "a", 1), (1, "b", 2), (1, None, 4), (2, "a", 8))
    with pytest.raises(SparkRuntimeException, match="kind"):
        reshape.to_wide(long, ["id"], "kind", "v", {"a": "a"}, agg="sum").collect()
    wide = reshape.to_wide(long, ["id"], "kind", "v", {"a": "a"}, agg="sum", rest="rest")
    assert rows(wide, "id", "a", "rest") == [(1, 1, 6), (2, 8, None)]


def test_holders_of_unlisted_types_count(spark):
    import datetime as dt

    d = dt.date(2005, 3, 31)
    raw = table(spark, "mgrno long, rdate date, fdate date, typecode int", *[(k, d, d, c) for k, c in enumerate((1, 6, None))])
    assert rows(holders.holder_counts(raw), "bank", "unlisted", "total") == [(1, 2, 3)]


def test_widening_over_found_categories(spark):
    long = table(spark, "id int, kind string, v int", (1, "a", 1), (1, "b", 2), (2, "c", 8), (3, "a", None))
    wide = reshape.to_wide_found(long, ["id"], "kind", "v")
    assert wide.columns == ["id", "a", "b", "c"]
    assert rows(wide) == [(1, 1, 2, None), (2, None, None, 8), (3, None, None, None)]
    assert rows(reshape.to_wide_found(long, ["id"], "kind", "v", "count", prefix="n_"), "id", "n_a", "n_c") == [(1, 1, None), (2, None, 1), (3, 0, None)]
    numbers = long.selectExpr("id", "case kind when 'a' then 2000 else 1999 end as year", "v")
    assert reshape.to_wide_found(numbers, ["id"], "year", "v", "sum", prefix="y").columns == ["id", "y1999", "y2000"]
    empty = reshape.to_wide_found(long.limit(0), ["id"], "kind", "v")
    assert empty.columns == ["id"] and empty.count() == 0


def test_found_categories_have_a_bound_and_names_of_their_own(spark):
    many = spark.range(50).selectExpr("1 as id", "concat('k', id) as kind", "1 as v")
    assert len(reshape.found_categories(many, "kind", 50)) == 50
    with pytest.raises(ValueError, match="more than 49"):
        reshape.to_wide_found(many, ["id"], "kind", "v", most=49)
    clash = table(spark, "id int, kind string, v int", (1, "id", 1))
    with pytest.raises(ValueError, match="prefix"):
        reshape.to_wide_found(clash, ["id"], "kind", "v")


def test_late_checks_of_found_categories(spark):
    long = table(spark, "id int, kind string, v int", (1, "a", 1), (1, None, 4))
    with pytest.raises(SparkRuntimeException, match="kind"):
        reshape.to_wide_found(long, ["id"], "kind", "v").collect()
    assert rows(reshape.to_wide_found(long, ["id"], "kind", "v", "sum", rest="other")) == [(1, 1, 4)]
    twice = table(spark, "id int, kind string, v int", (1, "a", 1), (1, "a", 1), (2, "a", 3))
    with pytest.raises(SparkRuntimeException, match="repeated"):
        reshape.to_wide_found(twice, ["id"], "kind", "v").collect()


def test_widening_is_one_shuffle(spark):
    wide = reshape.to_wide_found(spark.range(100).selectExpr("id % 7 as id", "id % 3 as kind", "id as v"), ["id"], "kind", "v", "sum", prefix="k")
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_excluded_issues_by_end_or_anywhere(spark):
    issues = table(spark, "gvkey string, iid string, cusip string", ("1", "01C", "123456789"), ("2", "C01", "22345678X"), ("3", "01", "3234"), ("4", None, "4"))
    assert [r[0] for r in rows(link.security_codes(issues), "gvkey")] == ["2", "3"]
    assert rows(link.security_codes(issues, rule="contains")) == [("3", "3234")]
    assert len(rows(link.security_codes(issues, None, "contains"))) == 4
    with pytest.raises(ValueError):
        link.security_codes(issues, rule="starts")

"""Column functions on hand-traced values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressmill.functions import datelines, dates, records, rules, text, urls


def one(spark, column, **values):
    """``column`` evaluated on one row of string values."""
    schema = ", ".join(f"{k} string" for k in values)
    df = spark.createDataFrame([tuple(values.values())], schema)
    return df.select(column.alias("v")).first().v


def table(spark, cases, make):
    """``make(col)`` over many inputs at once, in order."""
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    return [r.v for r in df.select("i", make(F.col("c")).alias("v")).orderBy("i").collect()]


CLEAN = [
    ("BC-X TYPE: CN ))Body TYPE: CN", "Body TYPE: CN"),
    ("BC-X type: OCN \n))Body", "Body"),
    ("One\nBC-X TYPE: CN ))Body", "One\nBC-X TYPE: CN ))Body"),
    ("AP (new lede,  12))Body", "Body"),
    ("Keep. _SOME information for this report came\nfrom x", "Keep. "),
    ("Keep. _NEW: tail\nmore", "Keep. "),
    ("Keep. _NEW:", "Keep. _NEW:"),
    ("Keep. _new: tail", "Keep. _new: tail"),
    ("A please turn on javascript. Media requires JavaScript to play. B", "A  B"),
    ("_WikiLeaks_ said", "WikiLeaks said"),
    ("a\r\n\n\rb", "a\nb"),
]


def test_boilerplate(spark):
    assert table(spark, [a for a, _ in CLEAN], text.strip_boilerplate) == [b for _, b in CLEAN]


def test_boilerplate_on_long_text(spark):
    """A rule that runs to the end of the text must not exhaust the stack."""
    got = one(spark, text.strip_boilerplate(F.col("t")), t="Keep. _NEW:" + "word\n" * 200_000)
    assert got == "Keep. "


ASCII = [
    ("Straße café* #1", "Strasse cafe 1"),
    ("plain * text #", "plain  text "),
    ("ÀÉÎÕÜ çñ Žižek Łódź Ørsted Đà Nẵng", "AEIOU cn Zizek Lodz Orsted Da Nang"),
    ("“Smart” ‘quotes’ – one — two… • €5 £6 ½ ©", "\"Smart\" 'quotes' - one -- two...  EUR5 PS6 1/2 (c)"),
    ("é and 漢字", "e and "),
    ("", ""),
]


def test_ascii(spark):
    assert table(spark, [a for a, _ in ASCII], text.to_ascii) == [b for _, b in ASCII]


def test_whitespace_rules(spark):
    given = ['a \t\n b  "c"**\n\nd']
    assert table(spark, given, text.squeeze_ws) == ['a b "c"** d']
    assert table(spark, given, text.space_out) == ["a    b   c **  d"]
    assert table(spark, given, text.squeeze_marks) == ['a   b  "c" d']
    assert table(spark, given, text.space_out_lines) == ['a    b  "c"**  d']


FILTER = [
    # source, url, title, content, kept
    ("Reuters", "u", "UPDATE 1-Talks resume", "c", False),
    ("Reuters", "u", "UPDATED talks", "c", True),
    ("Reuters", "u", "REFILE-Talks", "c", False),
    ("Reuters", "u", "DIARY - Africa", "c", False),
    ("Reuters", "u", "REG Notice", "c", False),
    ("Reuters", "u", "REGIONAL Notice", "c", True),
    ("Reuters", "u", "RCS Notice", "c", False),
    ("Reuters", "u", "t", "x (Reuters Life!) - y", True),
    ("Reuters", "u", "t", "So Reuters Life!x", False),
    ("Reuters", "u", "t", "by PRNewswire", False),
    ("Reuters", "http://h/a-MW-b", "t", "c", False),
    ("Reuters", "http://h/idMW2014", "t", "c", True),
    ("Reuters", "http://h/éMW", "t", "c", False),
    ("UPI", "u", "NBA scores", "c", False),
    ("UPI", "u", "Best of the NBA ", "c", True),
    ("UPI", "u", "Best of the NBA - x", "c", True),
    ("UPI", "u", "t", "Rafael Nadal won", False),
    ("UPI", "u", "t", "protoCOL", True),
    ("UPI", "u", "t", "éCOL x", False),
    ("UPI", "u", "UPI NewsTrack Quirks", "c", False),
    ("XNA", "u", "Flash: quake", "c", False),
    ("XNA", "u", "A flash: quake", "c", True),
    ("BBC", "http://h/news/magazine-1", "t", "c", False),
    ("BBC", "u", "x World News for Schools y", "c", False),
    ("AP", "http://h/MW", "UPDATE 1-Talks Flash:", "PRNewswire Nadal", True),
]


def test_article_rules(spark):
    df = spark.createDataFrame(
        [(i, *row[:4]) for i, row in enumerate(FILTER)],
        "i int, source string, url string, title string, content string",
    )
    kept = rules.is_kept(*[F.col(c) for c in ("source", "url", "title", "content")])
    got = [r.k for r in df.select("i", kept.alias("k")).orderBy("i").collect()]
    assert got == [row[4] for row in FILTER]


DATES = [
    ("AP", " Jun. 3, 2014 ", dt.datetime(2014, 6, 3)),
    ("AP", "June 3, 2014", None),
    ("BBC", "3 June 2014", dt.datetime(2014, 6, 3)),
    ("BBC", "03  june 2014", dt.datetime(2014, 6, 3)),
    ("BBC old", "17:09 GMT, Tuesday, 3 June 2014", dt.datetime(2014, 6, 3, 17, 9)),
    ("BBC old", "17:09 GMT, Tuesday, 3 June 2014 18:09 UK", dt.datetime(2014, 6, 3, 17, 9)),
    ("BBC old", "17:09 GMT, 3 June 2014", None),
    ("Reuters", "Tue Jun 3, 2014 4:05pm EDT", dt.datetime(2014, 6, 3, 16, 5)),
    ("Reuters", "Tue Jan 7, 2014 12:05AM EST", dt.datetime(2014, 1, 7, 0, 5)),
    ("Reuters", "Tue Jan 7, 2014 12:05AM GMT", None),
    ("Reuters", "Jan 7, 2014 12:05AM EST", None),
    ("UPI", "Updated June 3, 2014 at 3:45 PM", dt.datetime(2014, 6, 3, 15, 45)),
    ("UPI", "Published:   June 3, 2014 at 3:45 PM   |", dt.datetime(2014, 6, 3, 15, 45)),
    ("UPI", "| Sept. 3, 2014 at 3:45 AM", dt.datetime(2014, 9, 3, 3, 45)),
    ("UPI", "Jan. 3, 2014 at 12:00 PM", dt.datetime(2014, 1, 3, 12)),
    ("UPI", "yesterday", None),
    ("VOA", "Last updated on: June 3, 2014 03:45 PM", dt.datetime(2014, 6, 3, 3, 45)),
    ("VOA", "June 3, 2014 15:45 PM", dt.datetime(2014, 6, 3, 15, 45)),
    ("VOA", "June 3, 2014 15:45", None),
    ("XNA", "2014-06-03 01:02:03", dt.datetime(2014, 6, 3, 1, 2, 3)),
    ("XNA", "2014-13-03 01:02:03", None),
]


def test_dates(spark):
    df = spark.createDataFrame([(i, s, d) for i, (s, d, _) in enumerate(DATES)], "i int, s string, d string")
    value = F.lit(None).cast("timestamp")
    for source in dates.FORMATS:
        parsed = dates.parse_date(dates.clean_date_text(F.col("d"), source), source)
        value = F.when(F.col("s") == source, parsed).otherwise(value)
    shown = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    got = [r.v for r in df.select("i", shown.alias("v")).orderBy("i").collect()]
    assert got == [str(want) if want else None for _, _, want in DATES]


def test_scraped_at_is_utc_text(spark):
    given = F.lit("2014-06-03 10:00:00").cast("timestamp")
    assert one(spark, dates.scraped_at(given), x="") == "2014-06-03 10:00:00"
    assert len(one(spark, dates.scraped_at(), x="")) == 19


def test_datelines(spark):
    assert table(
        spark, ["X, June 3 (UPI) -- One. (UPI) -- Two.", "no marker"], datelines.cut_upi
    ) == ["One.  Two.", ""]
    assert table(
        spark, ["BEIJING -- Talks began -- ended", "no\nmarker", "a --"], datelines.cut_xna
    ) == ["Talks began", "no\nmarker", ""]
    assert table(
        spark,
        ["P (Reuters) - a", "P (Reuters) - a (Reuters) - b", "plain"],
        datelines.cut_reuters,
    ) == [" a", "P (Reuters) - a (Reuters) - b a  b", "plain"]


def test_keywords(spark):
    assert table(spark, ["a war", "Wary", "peace"], lambda c: datelines.has_keyword(c, ("war", "pe"))) == [
        True, False, True,
    ]
    assert table(spark, ["a"], lambda c: datelines.has_keyword(c, ())) == [False]


RESOLVE = [
    ("http://h/a/b?x=1#f", "http://o/p", "http://o/p"),
    ("http://h/a/b?x=1#f", "//o/p", "http://o/p"),
    ("https://h/a/b", "/c?d#e", "https://h/c?d#e"),
    ("http://h/a/b", "c", "http://h/a/c"),
    ("http://h/a/b/", "c", "http://h/a/b/c"),
    ("http://h", "c", "http://h/c"),
    ("http://h/a/b?x", "?y=2", "http://h/a/b?y=2"),
    ("http://h/a/b?x#f", "#g", "http://h/a/b?x#g"),
    ("http://h/a/b?x#f", "", "http://h/a/b?x"),
    ("http://h/a/b/c", "../d", "http://h/a/d"),
    ("http://h/a/b/c", "../../../d", "http://h/d"),
    ("http://h/a/b/c", "./d/./e/..", "http://h/a/b/d/"),
    ("http://h/a", "mailto:x@y", "mailto:x@y"),
    ("http://h/a", "/x/../y?z=../w", "http://h/y?z=../w"),
]


def test_resolve(spark):
    df = spark.createDataFrame([(i, b, h) for i, (b, h, _) in enumerate(RESOLVE)], "i int, b string, h string")
    got = df.select("i", urls.resolve_url(F.col("h"), F.col("b")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [want for _, _, want in RESOLVE]


def test_hosts_and_url_dates(spark):
    assert table(
        spark,
        ["http://WWW.upi.com/a", "http://m.www.upi.com/", "http://notwww.upi.com/", "no url", "http://[bad"],
        lambda c: F.coalesce(urls.host_in(urls.host_of(c), ("www.upi.com",)), F.lit(False)),
    ) == [True, True, False, False, False]
    assert table(
        spark, ["http://h/2014/05/06/x/2015/01/01", "http://h/2014/13/06/x", "http://h/"], urls.url_date
    ) == [dt.date(2014, 5, 6), None, None]
    assert table(spark, ["http://h/12345/2014", "none"], urls.url_year) == [1234, None]


def test_records(spark):
    rid = records.record_id(F.lit("20140601"), F.lit("AP"), F.col("n").cast("bigint"), F.lit(1))
    assert table(spark, ["1", "12345678"], lambda c: records.record_id(
        F.lit("20140601"), F.lit("AP"), c.cast("bigint"), F.lit(2))) == [
        "20140601 AP-0000001-2", "20140601 AP-12345678-2",
    ]
    assert one(spark, records.sentence_record(rid, F.col("s")), n="1", s="a\nb") == "20140601 AP-0000001-1\nab\n"
    assert (
        one(spark, records.index_line(rid, F.col("t"), F.lit("http://u")), n="1", t="China's talks - Xinhua | English")
        == "20140601 AP-0000001-1 'China\\'s talks | English' http://u"
    )


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        parsed = dates.parse_date(dates.clean_date_text(F.col("d"), "Reuters"), "Reuters")
        got = one(spark, dates.render_date(parsed, "yyyyMMdd HHmm"), d="Tue Jun 3, 2014 4:05pm EDT")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == "20140603 1605"


def test_other_scripts_are_spelled_and_the_rest_is_counted(spark):
    cases = {
        "Президент Путин said": ("Prezident Putin said", 0),
        "Щука, Ёж": ("Shchuka, Iozh", 0),
        "Αθήνα": ("Athena", 0),
        "a\u2003b\u2020": ("a b+", 0),
        "東京 talks": (" talks", 2),
        "e\u0301t\u00e9": ("ete", 0),
        "plain": ("plain", 0),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    rows = df.select("t", text.to_ascii(F.col("t")).alias("a"), text.unspelled(F.col("t")).alias("n")).collect()
    assert {r.t: (r.a, r.n) for r in rows} == cases

"""Names that clash, deep pages, long runs: every operator takes them, and gives the result that its docstring says."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from convivio.llm import (compression_quality, exact_duplicates, html_text, license_scan, line_runs, mixing,
                          near_duplicates, personal_data, quality_rules)

HELPERS = ["_id", "_key", "_m", "_mark", "_range", "_at", "_class", "_r", "_before", "_share", "_found", "_hits", "_rest",
           "_words", "_present", "_d", "_k", "cut", "seq", "digest", "stay_id", "row", "node", "low", "no", "e", "stats"]
ROWS = [(1, "the mit license covers the source\n" * 4 + "call +1 555 010 9999 now", "src0"), (2, None, None), (3, "", "src1"),
        (None, "no id here but words enough for some shingles of five", "src0"), (1, "the mit license covers the source\n" * 4, "src0"),
        (4, "the mit license covers the source\n" * 4 + "call +1 555 010 9999 now", "zz")]


def clashing(spark, rows=ROWS):
    """Documents with a column for every helper name, whose values say which column they are."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *[F.concat(F.lit(f"{h}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(h) for h in HELPERS])


def model():
    return compression_quality.Model(b"", b"", (0.0, 0.0), (1.0, 1.0), (0.0,) * 6, 0.5)


OPERATORS = {
    "op1": lambda d: quality_rules.judge(d, []), "op2": near_duplicates.one_of_each,
    "op5": lambda d: compression_quality.score(d, compression_quality.fit(d, d.select("doc_id", F.lit(1).alias("quality")))),
    "op6": lambda d: personal_data.find(d, personal_data.Tagger()), "op7": mixing.interleave, "op8": license_scan.scan,
    "op9": line_runs.dedup_lines, "op13": exact_duplicates.without_copies}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_extra_columns_come_back_as_they_were(spark, name):
    docs = clashing(spark)
    out = OPERATORS[name](docs)
    extra = [h for h in HELPERS if h in out.columns]
    assert set(HELPERS) - set(extra) <= {"stats"} and len(set(out.columns)) == len(out.columns)
    rows = out.collect()
    assert rows and (name in ("op2", "op13") or len(rows) == len(ROWS))
    for r in rows:
        said = "-" if r.doc_id is None else str(r.doc_id)
        assert all(r[h] == f"{h}:{said}" for h in extra if h != "stats")
    empty = OPERATORS[name](docs.limit(0))
    assert empty.columns == out.columns and empty.count() == 0


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td colspan=2>wide head<td>c<tr><td>a<td>b<td>d</table>", "wide head  c\na  b       d"),
    ("<table><tr><td colspan=3>abcd<td>x</table>", "abcd  x"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2<tr><td>z<td>3</table>", "r  1\n   2\nz  3"),
    ("<table><tr><td rowspan=0>r<td>1<tr><td>2<tr><td>3</table>", "r  1\n   2\n   3"),
    ("<table><tr><td><p>a<p>b</td><td>x<tr><td>c<td>y</table>", "a  x\n\nb\nc  y"),
    ("<table><tr><td>x<td><table><tr><td>in<td>ner<tr><td>second<td>q</table><td>y</table>", "x  in      ner  y\n   second  q"),
    ("<table><tr><td hidden>no<td>b<tr><td>c<td>d</table>", "b\nc  d"),
    ("<ol start=5><li>a<li value=9>b<li>c</ol>", "5. a\n9. b\n10. c"), ("<ol start=x><li>a</ol>", "1. a"),
    ("<p>pick <select><optgroup label='G &amp; H'><option>one</select>", "pick\nG & H\none"),
    ("<i aria-hidden=true>x</i><table><caption>cap</caption><tr><td>1</table>", "x\n\ncap\n1"),
])
def test_op4_tables_and_lists(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<table><tr><td>" * 5000 + "deep", "deep"), ("<table><tr><td>a<td>" * 1200 + "deep", "a  " * 1200 + "deep"),
    ("<div>" * 100_000 + "x", "x"), ("<p>" * 50_000 + "x", "x"), ("<b>" * 50_000 + "</i>" * 50_000 + "y", "y"),
    ("<table>" + "<tr><td colspan=1000 rowspan=9999>a" * 1000 + "</table>", None), ("x " * 500_000, ("x " * 500_000).strip()),
])
def test_op4_deep_and_long_pages(page, text):
    began = time.perf_counter()
    got = html_text.visible_text(page)
    assert time.perf_counter() - began < 20 and (text is None or got == text)


def test_op4_tables_of_pages(spark):
    rows = [(1, None, "t", 5), (1, None, "t", 5), (2, "", "t", 6), (3, "<p>a<p>b", "t", 7)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, n_lines int")
    assert sorted(map(tuple, html_text.extract(pages).collect())) == [(1, "", 0), (1, "", 0), (2, "", 0), (3, "a\n\nb", 3)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_op6_base_scans_equal_the_patterns():
    email, ip, draw = re.compile(personal_data.EMAIL), re.compile(personal_data.IP), np.random.default_rng(2)
    for _ in range(20_000):
        text = "".join(draw.choice(list("a1.@-+ 2"), draw.integers(24)))
        want = [("email", *m.span()) for m in email.finditer(text)]
        want += [("ip", *m.span()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        assert [s for s in personal_data.base_spans(text) if s[0] in ("email", "ip")] == want


@pytest.mark.parametrize("text", [
    "1" * 300_000, "1" * 9000 + ".2.3.4", "0" * 9000 + "1.2.3.4", "a" * 300_000 + "@", "a@" * 100_000, "1." * 100_000, "+1" * 100_000,
    "a.b@" + "c." * 100_000, "(at) " * 20_000])
def test_op6_long_runs_take_linear_time(text):
    began = time.perf_counter()
    spans = personal_data.base_spans(text)
    assert time.perf_counter() - began < 5
    assert spans == ([("ip", 0, 9007)] if text.startswith("0") else spans)


# Spans in other words and forms than those planted in training.
WRITTEN = {"email": ["jane (at) example.org", "peter(at)firma.de", "k.lee @ corp.com"],
           "ip": ["2001:db8:85a3::8a2e:370:7334", "fe80::1ff:fe23:4567:890a"],
           "card": ["3782 822463 10005", "4111 1111 1111 1112"], "phone": ["020 7946 0958", "(415) 555-2671", "01632 960983"]}


def test_op6_recall_by_kind_on_other_forms(spark, data):
    docs = spark.read.parquet(f"{data.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    tagger, draw = personal_data.fit(docs), np.random.default_rng(9)
    prose = [r.text for r in docs.filter(F.length("text").between(300, 4000) & ~F.col("text").rlike("[0-9@]")).orderBy("doc_id").limit(100).collect()]
    for kind, items in WRITTEN.items():
        hit = 0
        for item in items * 5:
            text = prose[draw.integers(len(prose))]
            at = text.rfind(" ", 0, int(draw.integers(50, len(text) - 50))) + 1
            spans = personal_data.all_spans(tagger, text[:at] + item + " " + text[at:])[1]
            hit += any(k == kind and min(e, at + len(item)) - max(b, at) >= 0.7 * len(item) for k, b, e in spans)
        assert hit >= 0.6 * 5 * len(items), (kind, hit)

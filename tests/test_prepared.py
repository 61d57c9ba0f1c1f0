"""Calls that are read once for many values, against their expansion with each value."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta, timezone

from pyspark.sql import functions as F

from lexmill.functions import lazy
from lexmill.plans import core, parser  # noqa: F401
from lexmill.wikitext import clock, expand, scan
from lexmill.wikitext.prepared import OPEN, prepared, whole

NUMBERS = ["{{#expr: @ * 2 + 1}}", "{{#ifexpr: @ mod 2 = 0 | even @ | odd}}", "{{formatnum:{{formatnum:@}}|R}}", "{{#ifeq:@|@.0|same|different}}", "{{plural:@|one|2=two|many}}", "{{#switch:{{#expr:@ mod 3}}|0=a|1=b@|#default=c}}", "{{#iferror:{{#expr:@/0}}|bad|ok}}", "{{#expr: @ > 700 and not (@ mod 2 = 1)}}"]
ODD = ["{{#expr:1@}}", "{{#expr:2 @}}", "{{#expr: - @ ^ 2}} {{#expr:@ round 2 + sin @}}", "{{@}}{{lc@:A}}{{@:A}}", "{{#tag:ref|@|name=@}}", "{{subst:lc:@}}", "{{#time:Y|@|de}}", "{{t|@}}", "[[{{lc:@}} ]] {{ uc : @", "{{{1|@}}}", "}} {{lc：@}}", "{{#switch:@|{{lc:A}}=1|#default=@z|q}}{{#switch:@}}", "{{klein:@X}}{{urlencode:@|WIKI}}{{localurl:@|a=@}}", "a@<!-- @ -->"]
VALUES = ["", " ", "0", "00", "5", "-5", "-0", "1.5", "1.", "1e5", "12 3", "999999999999999", "12345678901234567", "a", "x|y", "{{!}}", "}}", "{{", "[[a", "<nowiki>", "<!--", "0=a", "#default", "&lt;", "é", "½", "٣", "1995-02-30", "12:30", "n\nb"]
CONTEXT = expand.Context(now=datetime(2026, 3, 31, tzinfo=UTC), aliases={"klein": "lc"})


def test_prepared_calls_give_what_their_expansion_gives():
    for call in [*NUMBERS, *ODD, "\x1e".join(NUMBERS + ODD)]:
        function = prepared(call.replace("@", OPEN), CONTEXT)
        assert [function(v) for v in VALUES] == [whole(call.replace("@", v), CONTEXT) for v in VALUES], call


def test_a_call_is_read_once_for_all_values(monkeypatch):
    reads, pairs = [], scan.pairs
    monkeypatch.setattr(scan, "pairs", lambda text: reads.append(text) or pairs(text))
    function = prepared("".join(NUMBERS).replace("@", OPEN), CONTEXT)
    before = len(reads)
    for i in range(1000):
        function(str(i))
    assert len(reads) == before


def _orders(spark, tmp_path, n: int, at: str) -> str:
    spark.range(n, numPartitions=1).select(F.col("id").alias("o_orderkey"), F.expr(at).alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_numbers_of_one_file_are_spread_and_whole(spark, tmp_path):
    got = core.QUERIES["parser_numbers"](spark, _orders(spark, tmp_path, 3000, "timestamp'1995-01-01'")).withColumn("p", F.spark_partition_id()).collect()
    assert len({r.p for r in got}) > 1
    assert sorted((r.o_orderkey, r.expr, r.ifexpr, r.formatnum, r.bare, r.ifeq, r.plural, r.switch, r.iferror, r.padleft, r.chosen, r.truth) for r in got) == [
        (i, str(2 * i + 1), "odd" if i % 2 else "even", f"{i:,}", str(i), "same", "one" if i == 1 else "many", "abc"[i % 3], "bad", f"{i:08}", "in" if i % 4 in (1, 2) else "out", str(int(i > 700 and i % 2 == 0))) for i in range(3000)
    ]


TIMES = ["{{#time:j F Y|@}}", "{{#time:z W N t|@}}", "{{#formatdate:@|mdy}}", "{{#iferror:{{#time:Y|@ nonsense}}|Error|fine}}", "{{#time:Y-m-d|-1 month}}", "{{#time:\\\\Y \"Y\" xg c|@}}", "{{CURRENTYEAR}}"]
DATES = ["1995-02-28 00:00:00", "2024-02-29 23:59:59", "1900-02-29 00:00:00", "0001-01-01", "9999-12-31 23:59:59", "2001-08-01 24:00:00", "12:30", "today", "yesterday", "tomorrow", "now", "Midnight", "", "1 March 99", "20260331120000", "@86400", "-2 days", "last day of next month"]


def test_prepared_times_give_what_their_expansion_gives():
    for call in [*TIMES, "\x1e".join(TIMES)]:
        function = prepared(call.replace("@", OPEN), CONTEXT)
        assert [function(v) for v in DATES] == [whole(call.replace("@", v), CONTEXT) for v in DATES], call


def test_equal_instants_of_two_zones_are_not_taken_for_each_other():
    here = datetime(2026, 3, 31, 23, tzinfo=UTC)
    there = here.astimezone(timezone(timedelta(hours=3)))
    assert [clock.read("today", now).day for now in (here, there, here)] == [31, 1, 31]


def test_a_value_that_comes_again_is_evaluated_once():
    seen = []
    run = lazy.looked_up(lambda v: seen.append(v) or v * 2)
    assert [run(v) for v in ("a", "b", "a", None, "b")] == ["aa", "bb", "aa", None, "bb"] and seen == ["a", "b"]


def test_times_of_one_file_are_spread_and_whole(spark, tmp_path):
    got = core.QUERIES["parser_times"](spark, _orders(spark, tmp_path, 3000, "timestamp'1995-01-01 06:07:08' + make_interval(0, 0, 0, cast(id % 900 as int))")).withColumn("p", F.spark_partition_id()).collect()
    assert len({r.p for r in got}) > 1
    want = []
    for i in range(3000):
        t = datetime(1995, 1, 1, 6, 7, 8, tzinfo=UTC) + timedelta(i % 900)
        last = (t.replace(day=28) + timedelta(4)).replace(day=1) - timedelta(1)
        want.append((i, f"{t.day} {t:%B %Y}", f"{t:%a, %d %b %y}", f"{t:%Y%m%d%H%M%S}", f"{t.timetuple().tm_yday - 1} {t:%V} {t.isoweekday()} {last.day}", str(int(t.timestamp())), f'<span class="mw-formatted-date" title="{t:%Y-%m-%d}">{t:%B} {t.day}, {t.year}</span>', "2026-04-01", "2026-02-28", "Error", "2026"))
    assert sorted((r.o_orderkey, r.dmy, r.short, r.compact, r.numbers, r.unix, r.preferred, r.edge, r.moved, r.wrong, r.year) for r in got) == want

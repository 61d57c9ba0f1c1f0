"""The text problems against brute force and on awkward small inputs."""

from __future__ import annotations

import random
import string
from itertools import combinations

import numpy as np
import pytest

from lexmill.llm import lookalike, markup, packing, spans, tokens

# ---- markup ---------------------------------------------------------------------------

CASES = [
    ("== A ==\n* x\n* y", {"heading", "list"}),
    ("# a one.\n# b two.", {"list"}),
    ("# A heading\n\nText.", {"heading"}),
    ("#a\n#: b ''c''", {"list", "inline"}),
    ("; t : d", {"list"}),
    ("{|\n! a !! b\n|-\n| [[c]] || d\n|}", {"table", "inline"}),
    ("<pre>== no ==\n* [[no]] &amp;</pre>", {"code"}),
    ("x <math>''a''</math> y", {"formula"}),
    ("x <nowiki>''a''</nowiki>", {"inline"}),
    ("a <!-- == h == --> b", {"inline"}),
    ("<ul><li>a<li>b</ul><h2 class='x'>h</h2>", {"list", "heading"}),
    ("<table><tr><td>a<td><b>c</b></table>", {"table", "inline"}),
    ("<span class=\"math\">\\(x\\)</span> y", {"formula"}),
    ("<p>a &nbsp; b</p>", {"inline"}),
    ("Title\n=====\n\n- a\n- b", {"heading", "list"}),
    ("```py\n# no\n```\n\ntext **b**", {"code", "inline"}),
    ("| a | b |\n|:--|--:|\n| c | d |", {"table"}),
    ("text\n\n    code [x](y)\n\nmore `c`", {"code", "inline"}),
    ("$$\nx\n$$\n\n1. a\n2. b", {"formula", "list"}),
    ("It $x_1$ is *em*.", {"formula", "inline"}),
    ("\\section{A}\n\\begin{itemize}\n\\item b \\emph{c}\n\\end{itemize}", {"heading", "list", "inline"}),
    ("\\begin{tabular}{l}\na & b \\\\\n\\end{tabular}", {"table"}),
    ("\\begin{verbatim}\n\\section{no}\n\\end{verbatim}\ntext \\[x\\]", {"code", "formula"}),
    ("The price rose from $41 to $82 that year.", set()),
    ("Counts of a < 37 and b > 99. See no. #20 or note x* below.", set()),
    ("Here a == b never holds. The set {a, b} is closed. The form x [sic] is older.", set()),
    ("R&D notes & more; stored under C:\\abc\\19 as a_b_id. An arrow a -> b <- c, ~23% of 6^2.", set()),
    ("", set()),
]


@pytest.mark.parametrize(("source", "elements"), CASES)
def test_elements(source, elements):
    assert set(markup.cleaned(source)[1]) == elements


def test_structure_is_kept():
    text, _, _ = markup.cleaned("== A ==\n# x\n#: y\n# z\n\n{|\n! h !! i\n|-\n| a || b\n|}\n<source lang=py>\nf()\n</source>\n''e'' <math>q^2</math> [[b|c]] &amp; {{t|x|d}}")
    assert text == "## A\n\n1. x\n  : y\n2. z\n\n| h | i |\n| a | b |\n\n```\nf()\n```\n\ne $q^2$ c & d"


def test_density_drops_link_blocks_only():
    body = "<div>" + "<p>Long text of the entry, with many words and no links at all in it.</p>" * 6 + "</div>"
    menu = "<div>" + "".join(f"<a href='x'>menu {i}</a> " for i in range(12)) + "</div>"
    text, found, _ = markup.cleaned(menu + body)
    assert "Long text" in text and "menu 3" not in text and found == ["inline"]


PAGE = "<html><head><title>T</title><style>x</style></head><body><div>" + "".join(f"<a href='x'>menu {i}</a> " for i in range(20)) + "</div><h1>A</h1><ul><li>x</li><li>y</li></ul><p>" + "b " * 80 + "</p></body></html>"


def test_whole_pages():
    text, found, _ = markup.cleaned(PAGE)
    assert text == "# A\n\n- x\n- y\n\n" + ("b " * 80).strip() and found == ["heading", "list", "inline"]
    article = "<div><div>" + "<p>Words of the entry that go on and on without any link in them.</p>" * 5 + "</div><div><a>one</a> <a>two</a> <a>three</a></div></div>"
    text, _, _ = markup.cleaned(f"<body>{article}</body>")
    assert text.count("Words") == 5 and "two" not in text
    # a list of links is no menu, and structure inside of inline tags, items and loose cells stays
    assert markup.cleaned("* [[a]]\n* [[b]]")[0] == "- a\n- b"
    assert markup.cleaned("<b><h2>h</h2><ul><li>x<pre>c</pre></li></ul></b><td>d</td>")[0] == "## h\n\n- x\n\n```\nc\n```\n\n| d |"


def test_structure_of_every_source(sf):
    """Whatever a source has of headings, lists, tables, code and formulas is marked in its clean text."""
    import re

    import duckdb

    marks = {"heading": r"(?m)^#{1,6} ", "list": r"(?m)^ *(?:-|:|\d+\.) ", "table": r"(?m)^\| ", "code": "```", "formula": r"\$"}
    rows = duckdb.sql(f"select content_model, source from '{sf}/bundle_pages.parquet' where source <> '' union select null, source from '{sf}/bundle_expander.parquet' where source <> ''").fetchall()
    assert len(rows) > 100
    for hint, source in rows:
        text, found, _ = markup.cleaned(source, hint)
        assert all(re.search(marks[x], text) for x in found if x != "inline"), source


DEEP = ["<b>", "<div>", "<ul><li>", "<ul><li>a", "<table><tr><td>", "{{a|b", "''", "*", "<i><ul>", "\\textbf{", "\\begin{itemize}\\item ", "<nowiki>"]
WIDE = ["[[", "{{", "<pre>", "<a \n", "](", "![a](", "_a ", "`", "$", "\\(", "\\[", "\\begin{verbatim}", "\\verb|a ", "<!--", "= a =", "|--", "x", " ", "[http://a ", "\\item[", "# a #", "&", "\n", "```\n", "$$\n"]


@pytest.mark.parametrize("unit", DEEP + WIDE)
def test_deep_and_unclosed_markup_is_linear(unit):
    import time

    for source in (unit * 20_000, (unit * 200_000)[:200_000]):
        began = time.process_time()
        assert markup.cleaned(source + "\nend")[0] is not None
        assert time.process_time() - began < 10


def test_markup_rows(spark):
    rows = [("t", 1, "wikitext", "== h =="), ("t", 2, None, None), ("t", 3, "latex", ""), ("u", 1, "html", "a\x00b <i>" + "x" * 300_000), ("t", 4, None, "{{" * 500 + "x"), ("t", 5, None, "<div>" * 400)]
    df = spark.createDataFrame(rows, "src_table string, src_id long, hint string, source string")
    got = {(r.src_table, r.src_id): r for r in markup.converted(df).collect()}
    assert len(got) == len(rows)
    assert got["t", 1].elements == ["heading"] and got["t", 2].clean is None and got["t", 3].clean == ""
    assert len(got["u", 1].clean) >= 300_000
    assert markup.converted(df.where("false")).count() == 0


# ---- look-alikes ----------------------------------------------------------------------


def test_same_look(spark):
    left = spark.createDataFrame([("s", 1, 5, "p\u0430ge"), ("s", 1, 5, "p\u0430ge"), ("s", 2, 5, "page"), ("s", 3, 5, "Page"), ("s", 4, 6, "p\u0430ge"), ("s", 5, 5, None), ("s", 6, 7, "\u200b")], "src_table string, src_id long, key long, title string")
    right = spark.createDataFrame([("s", 5, 50, "page"), ("s", 5, 50, "page"), ("s", 7, 70, ""), ("s", 5, 51, None)], "src_table string, key long, page_id long, title string")
    got = {(r.src_id, r.page_id) for r in lookalike.same_look(left, right, ["src_table", "key"]).collect()}
    assert got == {(1, 50), (6, 70)}


@pytest.mark.parametrize(("a", "b", "same"), [("ﬁn", "fin", True), ("Café", "Cafe\u0301", True), ("p\u200bage", "page", True), ("x\u00a0y", "x y", True), ("Вода", "Boda", False), ("x²", "x2", False), ("①", "1", False), ("Page", "page", False)])
def test_form_is_coarser_than_look(a, b, same):
    from lexmill.functions.looks import look

    assert (look(a) == look(b)) == same
    assert lookalike.fold(a) == lookalike.fold(b) or a == "Вода"


def test_lookalike_brute_force(spark, sf):
    import duckdb

    from lexmill.functions.looks import look

    q = lambda sql: duckdb.sql(sql).fetchall()
    pages = q(f"select distinct id, ns, title from '{sf}/pages.parquet'")
    names = dict(q(f"select id, name from '{sf}/namespace_registry.parquet'"))
    expected = set()
    for i, page, title in q(f"select distinct revision_id, page_id, title from '{sf}/bundle_pages.parquet' where title is not null"):
        expected |= {("bundle_pages", i, p) for p, _, t in pages if p == page and t != title and look(t) == look(title)}
    for i, ns, title in q(f"select distinct id, ns, title from '{sf}/redirects.parquet' where title is not null and coalesce(interwiki, '') = ''"):
        full = (names[ns] + ":" if names.get(ns) else "") + title.replace("_", " ")
        expected |= {("redirects", i, p) for p, n, t in pages if n == ns and t != full and look(t) == look(full)}
    assert {tuple(r) for r in lookalike.found(spark, sf).collect()} == expected


# ---- tokens ---------------------------------------------------------------------------


def test_tokens_against_the_other_library(spark, sf):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids for r in tokens.corpus_ids(spark, sf).collect()}
    assert got == {i: t.encode(text, add_special_tokens=False).ids if text else [] for i, text in docs.items()}
    assert tokens.round_trip(spark, sf).where("not same").count() == 0


@pytest.mark.parametrize("text", ["a b", "x" * 40_000, "word  \n\n next " * 4000, "\u3000\u00a0 " * 9000, "<|endoftext|> it's 123", "é\U0001f600" * 9000, " " * 20_000 + "a", "a\n" * 15_000])
def test_pieces_are_safe(text):
    path = tokens.rank_file()
    parts = list(tokens.pieces(text, 100))
    assert "".join(parts) == text
    whole = tokens.encoding(path).encode_ordinary(text)
    assert [i for p in parts for i in tokens.encoding(path).encode_ordinary(p)] == whole == tokens.encode(text, path)
    assert tokens.decode(whole, path) == text


def test_tokens_of_nothing(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 4), (2, "", 4)], "doc_id long, text string, ids int")
    assert sorted((r.doc_id, r.ids) for r in tokens.encoded(df).collect()) == [(1, []), (2, []), (2, [])]
    assert tokens.encoded(df.where("false")).count() == 0


# ---- packing --------------------------------------------------------------------------


def _check(rows, sizes, capacity):
    used, parts = {}, {}
    for r in rows:
        used[r.bin_id] = used.get(r.bin_id, 0) + r.n_tokens
        parts.setdefault(r.doc_id, []).append((r.token_start, r.n_tokens))
    assert max(used.values()) <= capacity
    assert parts.keys() == sizes.keys()
    for i, p in parts.items():
        assert sum(n for _, n in p) == sizes[i]
        assert (len(p) == 1) == (sizes[i] <= capacity)
        at = 0
        for start, n in sorted(p):
            assert start == at
            at += n
    return used


def test_packing(spark):
    rng = random.Random(5)
    data = [(i, rng.choice(["a", "a", "b", None]), rng.choice([7, i, None]), rng.choice([0, 1, 5, 30, 100, 250, rng.randrange(1, 90)])) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, source string, cluster long, n_tokens long")
    sizes = {i: n for i, _, _, n in data}
    out = packing.packed(df, [("s", 100), ("l", 1000)]).collect()
    for name, capacity in (("s", 100), ("l", 1000)):
        used = _check([r for r in out if r.budget_name == name], sizes, capacity)
        assert len(used) <= -(-sum(sizes.values()) // capacity) + 1
    assert packing.packed(df.where("false"), [("s", 100)]).count() == 0


def test_best_fit_keeps_copies_apart():
    clusters = [1, 1, 2, 2] + [-1] * 40
    bins, clash = packing.best_fit([50] * 4 + [0] * 40, ["s"] * 44, clusters, 100)
    assert len(set(bins[:4])) == 2 and not clash.any()
    for b in set(bins[:4]):
        assert sorted(np.array(clusters[:4])[bins[:4] == b].tolist()) == [1, 2]
    rng = random.Random(8)
    sizes = sorted((rng.randrange(1, 100) for _ in range(3000)), reverse=True)
    bins, clash = packing.best_fit(sizes, ["s"] * 3000, (owners := [s * 40 + rng.randrange(40) for s in sizes]), 100)
    held = list(zip(bins.tolist(), owners, strict=True))
    assert len(held) - len(set(held)) == int(clash.sum()) == 0 and max(bins) + 1 <= sum(sizes) / 100 * 1.01 + 2


def test_more_copies_than_bins_are_marked():
    sizes, clusters = [4] * 3000 + [2] * 1000, [1] * 3000 + list(range(2, 1002))
    bins, clash = packing.best_fit(sizes, ["s"] * 4000, clusters, 10)
    assert len(set(bins)) == 1500  # no bin takes three items of 4
    held = list(zip(bins.tolist(), clusters, strict=True))
    assert len(held) - len(set(held)) == int(clash.sum()) >= 3000 - len(set(bins))
    assert not clash[3000:].any()


def test_packing_of_a_huge_text_and_of_nothings(spark):
    df = spark.createDataFrame([(1, "a", 5, 1_000_003), (2, None, None, 0), (3, None, None, 0), (4, "a", 7, 100)], "doc_id long, source string, cluster long, n_tokens long")
    rows = packing.packed(df, [("s", 10)]).collect()
    used = _check(rows, {1: 1_000_003, 2: 0, 3: 0, 4: 100}, 10)
    assert len(used) == 100_000 + 10 + 1 and not any(r.clash for r in rows)


# ---- spans ----------------------------------------------------------------------------


def _texts(rng: random.Random):
    word = lambda: "".join(rng.choices(string.ascii_lowercase + "é中", k=rng.randrange(2, 9)))
    filler = lambda n: " ".join(word() for _ in range(n))
    shared = [filler(40)[:n] for n in (119, 120, 121, 200)]
    hot = filler(30)[:60]
    docs = {}
    for i in range(60):
        parts = [filler(rng.randrange(0, 60))]
        if rng.random() < 0.5:
            parts.append(rng.choice(shared))
        if rng.random() < 0.7:
            parts.append(hot)
        rng.shuffle(parts)
        docs[i] = "|".join([str(i), *parts, str(i * 7)])
    docs |= {100: None, 101: "", 102: "x", 103: "a" * 300, 104: "a" * 130, 105: docs[3], 106: docs[3], 107: "ab" * 100, 108: "a" * 300, 109: "b" + "a" * 119}
    return docs


def _truth(docs, length):
    where = {}
    for i, t in docs.items():
        for at in range(len(t or "") - length + 1):
            where.setdefault(t[at : at + length], {}).setdefault(i, []).append(at)
    pairs, cover = set(), {}
    for holders in where.values():
        if len(holders) > 1:
            pairs |= set(combinations(sorted(holders), 2))
            for i, places in holders.items():
                for at in places:
                    cover.setdefault(i, set()).update(range(at, at + length))
    return pairs, {i: len(c) for i, c in cover.items()}


@pytest.mark.parametrize(("seed", "hot"), [(1, 64), (2, 2), (3, 8)])
def test_spans_against_brute_force(spark, seed, hot, monkeypatch):
    monkeypatch.setattr(spans, "HOT", hot)
    docs = _texts(random.Random(seed))
    df = spark.createDataFrame([(i, t, 0) for i, t in docs.items()], "doc_id long, text string, seed int")
    pairs, cover = _truth(docs, 120)
    got = [tuple(r) for r in spans.sharing_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    shares = {r.doc_id: r for r in spans.shares(df).collect()}
    assert {i: r.shared_chars for i, r in shares.items() if r.shared_chars} == cover
    assert shares.keys() == docs.keys() and shares[100].share == 0.0


def test_spans_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spans.sharing_pairs(df).count() == spans.shares(df).count() == spans.fuzzy_passages(df).count() == 0


def test_fuzzy_passage(spark):
    rng = random.Random(9)
    a, b = ("".join(rng.choices(string.ascii_lowercase, k=200)) for _ in range(2))
    df = spark.createDataFrame([(1, "111" + a + "XY" + b), (2, a + "Z" + b + "222")], "doc_id long, text string")
    (row,) = spans.fuzzy_passages(df).collect()
    assert (row.start_a, row.end_a, row.start_b, row.end_b, row.n_runs, row.exact_chars, row.edits) == (3, 405, 0, 401, 2, 400, 2)


def test_recall_of_fuzzy_passages(spark):
    """Passages of 400 characters with an edit in every 50 to 90: at least nine in ten pairs are found."""
    rng = random.Random(12)
    letters = string.ascii_lowercase + "    "
    text = lambda n: "".join(rng.choices(letters, k=n))
    docs, planted = [], set()
    for i in range(0, 80, 2):
        passage = text(400)
        edited, at = [], 0
        while at < 400:
            step = rng.randrange(50, 90)
            edited.append(passage[at : at + step])
            at += step
            kind = rng.randrange(3)
            edited.append(rng.choice("XYZ") if kind < 2 else "")
            at += kind != 1
        docs += [(i, text(300) + passage + text(200)), (i + 1, text(100) + "".join(edited) + text(400))]
        planted.add((i, i + 1))
    rows = spans.fuzzy_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {(r.doc_id_a, r.doc_id_b) for r in rows}
    assert found <= planted and len(found) >= 0.9 * len(planted)
    assert all(0.9 <= r.identity < 1 and 0 < r.edits < 40 for r in rows if r.n_runs > 1)


def _common_runs(x, y, least):
    """All longest common runs of at least ``least`` characters, by diagonals."""
    out = []
    for d in range(-len(x) + 1, len(y)):
        a, n = max(0, -d), 0
        for a in range(a, min(len(x), len(y) - d) + 1):
            if a < min(len(x), len(y) - d) and x[a] == y[a + d]:
                n += 1
            else:
                out += [(a - n, a - n + d, n)] if n >= least else []
                n = 0
    return out


def _edits(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, e in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != e))
    return row[-1]


@pytest.mark.parametrize(("hot", "block"), [(64, 1 << 14), (2, 1 << 14), (2, 5)])
def test_passages_of_all_places(spark, hot, block, monkeypatch):
    """Every passage stands at all its places and with all its characters, however many texts have its seeds and however often."""
    monkeypatch.setattr(spans, "HOT", hot)
    monkeypatch.setattr(spans, "BLOCK", block, raising=False)
    rng = random.Random(31)
    text = lambda n: "".join(rng.choices(string.ascii_lowercase + " é中", k=n))
    p, q = text(200), text(90)
    docs = {i: text(20) + rng.choice([p, p[:150], p[30:], q + "!" + q]) + text(20) for i in range(8)}
    docs |= {10: text(9) + p + text(60) + p + text(9), 11: p + text(30) + p[:130] + "#" + p[131:], 12: q + "?" + q + text(30) + q + "." + q}
    docs |= {20: "a" * 200, 21: "b" + "a" * 150 + "c", 22: "ab" * 90, 23: text(20) + "ab" * 70, 24: None, 25: "", 26: docs[0]}
    want = set()
    for x, y in combinations([i for i, t in docs.items() if t and i != 26], 2):
        runs = sorted(_common_runs(docs[x], docs[y], 48), key=lambda r: (r[1] - r[0], r[0]))
        for links in spans.chain(runs):
            of = [runs[i] for i in links]
            (a, b, _), (c, d, n) = of[0], of[-1]
            edits = sum(_edits(docs[x][f[0] + f[2] : g[0]], docs[y][f[1] + f[2] : g[1]]) for f, g in zip(of, of[1:], strict=False))
            if max(c + n - a, d + n - b) - edits >= 120:
                want.add((x, y, a, c + n, b, d + n, len(of), sum(r[2] for r in of), edits))
    rows = spans.fuzzy_passages(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    rows = rows.select("doc_id_a", "doc_id_b", "start_a", "end_a", "start_b", "end_b", "n_runs", "exact_chars", "edits").collect()
    assert len(want) > 100 and len(rows) == len(want) and {tuple(r) for r in rows} == want


def test_chain_prefers_order():
    runs = [(0, 0, 100), (150, 150, 100), (160, 20, 100), (300, 290, 50)]
    assert spans.chain(runs)[0] == [0, 1, 3]
    assert sorted(i for c in spans.chain(runs) for i in c) == [0, 1, 2, 3]

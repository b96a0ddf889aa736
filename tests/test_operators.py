"""Operators on small fixtures with known results."""

import pytest
from pyspark.sql import functions as F

from folioforge.functions import loops as lp
from folioforge.functions import similarity as si
from folioforge.functions import text as T
from folioforge.operators import audit, edits, graph, sequences, tables, votes
from folioforge.sources import pages as pg


def _one(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("line", "kind"),
    [("", "blank"), ("## Head", "heading"), ("- item", "list"), ("12. item", "list"), ("| a | b |", "table"), ("> said", "quote"), ("***", "rule"), ("```", "fence"), ("\tcode", "indented"), ("Plain words.", "prose")],
)
def test_line_kind(spark, line, kind):
    assert _one(spark, line, T.line_kind) == kind


def test_text_forms(spark):
    assert _one(spark, "## A b-1!", T.line_core) == "Ab1"
    assert _one(spark, "page １２ of 9", T.fold_numerals) == "page # of #"
    assert _one(spark, "一二〇", T.cjk_value) == 120
    assert _one(spark, "𠯲abcd", T.pieces) == ["𠯲abc", "abcd"]
    assert _one(spark, "ab", T.pieces) == ["ab"]
    assert _one(spark, "done.  ", T.sentence_finished) is True
    assert [_one(spark, x, T.cell_class) for x in ("", "……", "1,250", "7", "x")] == ["blank", "mark", "figure", "numeral", "text"]


def test_find_loops():
    assert lp.find_loops("ab" * 499) == []  # 998 characters
    assert lp.find_loops("ab" * 500) == [(0, 1000, "ab")]
    assert lp.find_loops("x" * 1500 + "tail") == [(0, 1500, "x")]
    unit = "".join(chr(97 + i % 26) for i in range(150)) + "#"
    text = unit * 8 + unit[:40]
    assert lp.find_loops(text) == [(0, len(text), unit)]  # the cut copy belongs to it
    assert lp.find_loops(unit * 8 + unit[:40] + " more")[0][1] == len(unit) * 8
    assert lp.find_loops("<br>" * 400) == []


def test_doubled_runs_have_no_upper_bound(spark, tmp_path):
    import random
    import re

    from folioforge.plans import CATALOGUE

    draw = random.Random(7)
    long = "".join(chr(97 + draw.randrange(26)) for _ in range(269))
    spark.createDataFrame([(5, f"x\n{long}{long} and again again and ", "s"), (6, None, "s"), (7, "short", None)], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = CATALOGUE["repeated_run"].run(spark, str(tmp_path)).collect()
    assert [(r.page, r.line_no, r.run) for r in got] == [(5, 1, long)]
    texts = ["", "abcdefgh" * 2, "a" * 1001, "abcdefg" * 2, "𠯲bcdefgh" * 2 + "-" + "12345678" * 3 + "987654321" * 2, long * 3]
    for _ in range(600):
        t = "".join(draw.choice("ab") for _ in range(draw.randrange(60)))
        for _ in range(draw.randrange(4)):
            u = "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(1, 120)))
            t += u * draw.randrange(1, 4)
        texts.append(t)
    want = [[m[1] for m in re.finditer(r"(.{8,})\1", t, re.S)] for t in texts]
    assert list(lp.find_doubled(texts)) == want
    assert list(lp.find_doubled(texts, chars=500)) == want


def test_tail_loop():
    assert lp.tail_loop("a" * 895) is None
    assert lp.tail_loop("a" * 896)[0] == 1
    passage = "".join(chr(33 + (i * 7) % 90) for i in range(400))
    period, copies, repeated, start = lp.tail_loop("begin " + passage * 3)
    assert (period, copies, repeated) == (90, pytest.approx(copies), repeated) or period == 400 or period % 90 == 0
    assert start + repeated == len("begin " + passage * 3)


def test_similarity():
    assert si.matched("a b c", "a x c")[0] == 2
    assert si.substitutions("cat sat", "cut sat") == [("a", "u")]
    assert si.page_errors("one two three", "one too three") == 3
    assert si.matched("", "") == (0, 1.0, 0)


EDITS = [(1, 0, 0, 0, "A", "r"), (1, 1, 0, 0, "B", "r"), (1, 2, 2, 4, "", "r"), (1, 3, 3, 5, "zz", "r"), (1, 4, 6, 7, "g", "r"), (1, 5, 4, 4, "+", "r")]


def test_edits_first_proposed_wins_and_replays(spark):
    page = spark.createDataFrame([(1, "abcdefg"), (2, None)], "page long, text string")
    e = spark.createDataFrame(EDITS, "page long, seq long, start long, end long, after string, rule string")
    done = edits.apply_edits(page, e).first()
    # the second insertion at 0 and the span over 3..5 are refused, the edit to g changes nothing
    assert (done.text, done.applied, done.refused) == ("Aab+efg", 3, 2)
    again = edits.replay(page, edits.edit_log(page, e)).first()
    assert again.ok and again.text == done.text
    found = {(r.first, r.second) for r in edits.conflicts(e).collect()}
    assert found == {(0, 1), (2, 3), (3, 5)}


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("x", "a")], "src string, dst string")
    roots = spark.createDataFrame([("a",)], "node string")
    assert {(r.node, r.depth) for r in graph.closure(e, roots).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert {r.node for r in graph.cycle_nodes(e).collect()} == {"b", "c"}
    stale = spark.createDataFrame([("c",), ("a",)], "node string")
    assert {(r.node, r.cause) for r in graph.stale_causes(e, stale).collect()} == {("c", "c"), ("a", "a"), ("b", "c"), ("x", "a")}
    assert graph.order_first([("b", "a"), ("c", "a"), ("d", "c")], ["d", "c", "b", "a"]) == ["a", "b", "c", "d"]


def test_sequences_and_votes(spark):
    s = spark.createDataFrame([("k", v) for v in (1, 2, 3, 7, 8)], "g string, v long")
    assert {(r["first"], r["last"], r["size"]) for r in sequences.contiguous_runs(s, "g", "v").collect()} == {(1, 3, 3), (7, 8, 2)}
    assert [(r.v, r.following, r.missing) for r in sequences.jumps(s, "g", "v").collect()] == [(3, 7, 3)]
    v = spark.createDataFrame([(14, 1, "adjudicate"), (15, 1, "A"), (9, 6, "adjudicate"), (16, 0, "A"), (2, 20, "B")], "a long, b long, want string")
    assert all(r.want == r.got for r in v.withColumn("got", votes.preference(F.col("a"), F.col("b"))).collect())
    b = spark.createDataFrame([(0, 0, 0, "none"), (2, 2, 4, "none"), (1, 0, 1, "none"), (2, 1, 4, "none"), (3, 1, 4, "A")], "a long, b long, n long, want string")
    assert all(r.want == r.got for r in b.withColumn("got", votes.ballot(F.col("a"), F.col("b"), F.col("n"))).collect())


def test_brackets(spark):
    p = spark.createDataFrame([("k", 1, "open ( here"), ("k", 2, "close ) and ) more ["), ("k", 3, None)], "book string, page long, text string")
    got = {(r.page, r.bracket, r.opened, r.unopened) for r in audit.bracket_tally(p).collect()}
    assert got == {(1, "(", 1, 0), (2, "(", 0, 2), (2, "[", 1, 0)}
    assert {(r.page, r.bracket) for r in audit.unbalanced_pages(audit.bracket_tally(p), p).collect()} == {(2, "("), (2, "[")}


def test_html_tables(spark):
    html = "<p>x</p><table><tr><th colspan=2>T</th></tr><tr><td rowspan=9>a</td><td>b&amp;c</td></tr><tr><td>d</td></tr></table>"
    rows = tables.parse_html(spark.createDataFrame([(1, html), (2, None)], "id long, html string"), "id", "html").collect()
    assert [(r.row, r.col, r.rowspan, r.colspan, r.text) for r in rows] == [(0, 0, 1, 2, "T"), (1, 0, 2, 1, "a"), (1, 1, 1, 1, "b&c"), (2, 1, 1, 1, "d")]


def test_tables_and_trees_of_documents_and_pages(spark, tmp_path):
    from folioforge.plans import CATALOGUE

    head = "A first line of more than thirty letters for both"
    table = "| Name | Count |\n|---|---|\n| alpha | 12 |\n| beta | 1,250 |"
    turned = "| Name | alpha | beta |\n| Count | 12 | 1,250 |"
    first = f"{head}\n{table}\ntext\nx | y\n- a\n  - b\n    - c\n\n  - d\n1. e\nend\n- f"
    second = f"{head}\n{turned}\n- a\n  - b\n- d"
    html = "<nav><ul><li>p<ul><li>q</li></ul></li><li>r</ul></nav><table><tr><td rowspan=2>1</td><td colspan=2>2</td></tr><tr><td>3</td></tr></table>"
    spark.createDataFrame([(1, first, "s"), (2, second, "s"), (3, None, None)], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(9, html), (10, None)], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    run = lambda name: {tuple(r) for r in CATALOGUE[name].run(spark, str(tmp_path)).collect()}
    cells = [["Name", "Count"], ["alpha", "12"], ["beta", "1,250"]]
    assert {x for x in run("document_tables_transposed") if x[0] == "1/0"} == {("1/0", c, r, t) for r, row in enumerate(cells) for c, t in enumerate(row)}
    assert {x for x in run("document_tables_rotated") if x[0] == "1/0"} == {("1/0", 1 - c, r, t) for r, row in enumerate(cells) for c, t in enumerate(row)}
    assert run("document_table_labels") == {("1/0", True), ("1/1", False), ("2/0", True)}
    assert run("document_table_scores") == {(1, 2, 0, 6, 6, 0.0, "transposed", True), (1, 2, 1, 2, 0, 12.5, "as written", False)}
    assert run("page_tables") == {("9/0", 0, 0, "1"), ("9/0", 0, 1, "2"), ("9/0", 1, 1, "3")}
    lists = {("", "a"), ("a", "b"), ("b", "c"), ("a", "d"), ("", "e")}
    assert run("document_trees") == {("documents", 1, 0, *e) for e in lists} | {("documents", 1, 1, "", "f")} | {("documents", 2, 0, *e) for e in (("", "a"), ("a", "b"), ("", "d"))} | {("pages", 9, 0, *e) for e in (("", "p"), ("p", "q"), ("", "r"))}
    assert run("document_tree_scores") == {("1/2/0", 5, 3, 2), ("1/2/1", 1, 0, 0)}


def test_strict_json(spark):
    rows = spark.createDataFrame([('{"a":1,"a":2}',), ('{"b":1}',), ("[]",), (None,), ('{"a":1}',)], "j string")
    got = [r.p for r in rows.select(pg.strict_json(F.col("j"), ["a"]).alias("p")).collect()]
    assert got == [["duplicate a"], ["unknown b", "missing a"], ["not an object"], ["not JSON"], []]


def test_page_files_and_selection(spark, tmp_path):
    (tmp_path / "page-0007.txt").write_text("seven\n")
    (tmp_path / "other.txt").write_text("no")
    assert [(r.page, r.text) for r in pg.page_files(spark, str(tmp_path)).collect()] == [(7, "seven\n")]
    assert sorted(r.page for r in pg.selected(spark, "1, 3-5").collect()) == [1, 3, 4, 5]


def test_manifest_and_closure_reach_all_rows(spark, tmp_path):
    from folioforge.plans import CATALOGUE

    spark.range(400, 405).selectExpr("id AS doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    assert {(r.scan_page, r.content) for r in CATALOGUE["manifest_scan_whole"].run(spark, str(tmp_path)).collect()} == {(201, "page"), (202, "page")}
    sf = "/root/testdata/sf0.001"
    nodes = {r.node for r in CATALOGUE["artifact_closure_whole"].run(spark, sf).collect()}
    assert {f"o{r.o_orderkey}" for r in spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey").collect()} <= nodes


def test_coverage_of_edited_copies(spark, tmp_path):
    from folioforge.plans import CATALOGUE

    item = "abcdefghijklmnopqrstuvwxyz" * 4
    edited = "".join("0" if i % 10 == 9 else x for i, x in enumerate(item))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(7, edited)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert [(r.item_id, r.doc_id) for r in CATALOGUE["shingle_coverage_fours"].run(spark, str(tmp_path)).collect()] == [(1, 7)]
    assert CATALOGUE["shingle_coverage"].run(spark, str(tmp_path)).count() == 0


def test_partition_invariance(spark):
    from compare import rows

    from folioforge.operators.furniture import recurring_lines
    from folioforge.sources.tables import books, lines, load

    docs = load(spark, "/root/testdata/sf0.001", "documents")
    assert rows(recurring_lines(lines(books(docs.repartition(7)))).toPandas()) == rows(recurring_lines(lines(books(docs.coalesce(1)))).toPandas())


def test_spans_that_meet():
    from folioforge.operators.edits import meet

    spans = [(a, b) for a in range(5) for b in range(a, 5)]
    for a, b in spans:
        for c, d in spans:
            if a == b and c == d:
                want = a == c
            elif a == b:
                want = c < a < d
            elif c == d:
                want = a < c < b
            else:
                want = bool(set(range(a, b)) & set(range(c, d)))
            assert meet(a, b, c, d) == want


def test_tail_loop_against_its_definition():
    import random

    random.seed(8)
    rule = lp.TailRule(copies=3, repeated=12, probe=4, longest=9, tries=3)
    for _ in range(3000):
        text = "".join(random.choice("ab") for _ in range(random.randint(0, 12))) + "".join(random.choice("ab") for _ in range(random.randint(1, 9))) * random.randint(1, 9)
        agree = lambda p: next((k for k in range(len(text) - p) if text[-1 - k] != text[-1 - k - p]), len(text) - p)
        want = None
        if len(text) >= 16:
            for p in [p for p in range(1, min(9, len(text) - 4) + 1) if agree(p) >= 4][:3]:
                if agree(p) >= max(12, 2 * p):
                    want = (p, round(1 + agree(p) / p, 2), agree(p), len(text) - agree(p))
                    break
        assert lp.tail_loop(text, rule) == want


def test_doubts_are_numbered_runs(spark):
    from folioforge.operators import doubts as db

    pages = spark.createDataFrame([("b", p) for p in (1, 2, 5, 9, 10)] + [("c", 3)], "book string, page long")
    one = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x"), (9, "x"), (3, "y")], "page long, kind string")
    two = spark.createDataFrame([(2, "y"), (5, "y")], "page long, kind string")
    got = sorted(map(tuple, db.doubt_list(pages, [one, two]).collect()))
    assert got == [("b", "Q0001", "x", 1, 2, 2), ("b", "Q0002", "y", 2, 5, 2), ("b", "Q0003", "x", 9, 9, 1), ("c", "Q0001", "y", 3, 3, 1)]
    assert db.doubt_list(pages, [one.limit(0)]).count() == 0


def test_gates_and_paths(spark):
    from pyspark.sql import functions as F

    from folioforge.operators import doubts as db

    rows = spark.createDataFrame([("a", 4), ("a", 4), ("a", 2), ("a", 2), ("b", 7), ("c", None)], "book string, n int")
    assert sorted(map(tuple, db.commonest(rows.where("n is not null"), "book", "n", 2).collect())) == [("a", 2, 2), ("b", None, 1)]
    paths = ["a/b.md", "", "/a", "~a", "a/../b", "..", "a..b", "c:\\x", "a\nb", "a/./b"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(db.safe_path(F.col("p"))).collect()
    assert [r[0] for r in got] == [True, False, False, False, False, False, True, False, False, True]
    left, right = (spark.createDataFrame([(x,) for x in xs], "k long") for xs in ([1, 2, 2, 3], [3, 4]))
    assert sorted(map(tuple, db.one_sided(left, right, "k").collect())) == [(1, "left"), (2, "left"), (4, "right")]
    turns = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 2), ("b", 3)], "g string, n long")
    assert sorted(map(tuple, db.continuity(turns, "g", "n").collect())) == [("a", 3, 1), ("b", 2, 1)]


def test_long_chains_have_no_depth_limit(spark):
    chain = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(52)], "src string, dst string")
    root = spark.createDataFrame([("n000",)], "node string")
    assert graph.closure(chain, root).agg({"depth": "max"}).first()[0] == 52
    with pytest.raises(ValueError, match="b, c"):
        graph.order_first([("b", "c"), ("c", "b")], ["a", "b", "c"])


def test_line_shares_against_sets():
    import random

    from folioforge.functions.novelty import line_shares

    def pieces(x):
        return {x[i : i + 4] for i in range(len(x) - 3)} if len(x) >= 4 else ({x} if len(x) >= 2 else set())

    rng = random.Random(3)
    for _ in range(200):
        lines = ["".join(rng.choices("ab漢𠀀é", k=rng.randrange(0, 12))) for _ in range(rng.randrange(1, 6))]
        before = "".join(rng.choices("ab漢𠀀é", k=rng.choice([0, 1, 2, 3, 4, 30, 300])))
        want = [len(pieces(x) & pieces(before)) / len(pieces(x)) if pieces(x) else None for x in lines]
        assert line_shares("\n".join(lines), before) == want


def test_numerals(spark):
    from folioforge.functions import numerals

    cases = {"二十五": 25, "一百零三": 103, "十": 10, "一七七": 177, "二〇": 20, "１２": 12, "一千零五十": 1050, "二三十": None, "": None, "十x": None, "零": 0, "百": 100}
    got = {r[0]: r[1] for r in spark.createDataFrame([(k,) for k in cases], "t string").select("t", numerals.numeral_value(F.col("t"))).collect()}
    assert got == cases
    numbers = spark.range(10000).select("id", numerals.numeral_value(numerals.written(F.col("id"))).alias("back"))
    assert numbers.where("NOT id <=> back").count() == 0


def test_split_dates(spark):
    from folioforge.functions.numerals import split_dates

    rows = [("在一九二八年五月廿三日晴", "在晴", 1928, 5, 23), ("九五年十二月", "", 95, 12, None), ("一九年十三月", "一九年十三月", None, None, None), ("無", "無", None, None, None), (None, None, None, None, None)]
    got = split_dates(spark.createDataFrame([r[:1] for r in rows], "line string"), "line").collect()
    assert [tuple(r) for r in got] == rows


def test_common_run_subsequence_and_chain(spark):
    from itertools import combinations

    from folioforge.functions import runs

    df = spark.createDataFrame([("abcd", "xbcdy", True), ("", "a", False), ("ac", "abc", False)], "a string, b string, x boolean")
    got = df.select(runs.common_run(F.col("a"), F.col("b")), runs.is_subsequence(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("bcd", False), ("", True), ("a", True)]
    for v in ([], [3], [3, 1, 2, 2, 5, 4], [5, 5, 5], [1, 9, 2, 8, 3, 7]):
        best = max((len(c) for k in range(len(v) + 1) for c in combinations(v, k) if all(x < y for x, y in zip(c, c[1:]))), default=0)
        chain = runs.rising_chain(v)
        assert len(chain) == best and all(v[i] < v[j] and i < j for i, j in zip(chain, chain[1:]))


def test_classes_of_a_long_chain_and_a_star(spark):
    from folioforge.operators.classes import classes

    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(2000, 2050)]
    got = {r["node"]: r["class"] for r in classes(spark.createDataFrame([*chain, *star, (5, 5), (None, 7)], "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 1000: 1000, **{i: 1000 for i in range(2000, 2050)}, 5: 5}


def test_shared_core_grows_while_most_texts_hold(spark):
    from folioforge.operators.classes import shared_cores

    rows = [("g", "xabc1")] * 19 + [("g", "yab")] + [("h", "q")] * 4 + [("n", None)]
    got = shared_cores(spark.createDataFrame(rows, "k string, t string"), "k", "t").collect()
    # ab stands in 20 texts, abc and xab in 19: the commonest longer ones, the least text first, and so on
    assert got[0]["core"] == "xabc1" and got[0]["texts"] == 19


def test_masks_keep_places():
    from folioforge.functions.masks import masked

    text = "---\na: 1\n---\nx <!-- (\n --> y `(` [l](u(v)\n```\n(\n```\nz ["
    out = masked(text)
    assert len(out) == len(text) and out.count("\n") == text.count("\n")
    assert out.split() == ["x", "y", "[l](u(v)", "z", "["]


def test_delimiters_against_one_stack():
    import random

    from folioforge.functions.masks import PAIRS, unpaired

    def plain(text):
        closes, stack, out = {b: a for a, b in PAIRS.items()}, [], []
        for i, ch in enumerate(text):
            if ch in PAIRS:
                stack.append((ch, i))
            elif ch in closes:
                hits = [k for k, (o, _) in enumerate(stack) if o == closes[ch]]
                if not hits:
                    out.append((i, "unmatched-closing-delimiter", ch))
                else:
                    if hits[-1] != len(stack) - 1:
                        out.append((i, "misnested-closing-delimiter", ch))
                    del stack[hits[-1]]
        return sorted(out + [(i, "unmatched-opening-delimiter", o) for o, i in stack])

    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choices("「」『』（）a", k=rng.randrange(30)))
        assert unpaired(text) == plain(text)


def test_rendered_table(spark):
    from folioforge.operators.classes import render_markdown

    cells = spark.createDataFrame([(1, 0, 0, "a|b"), (1, 0, 1, None), (1, 2, 0, "c\nd"), (1, 2, 1, "e"), (2, 0, 0, "h")], "table_id long, row long, col int, text string")
    assert {r[0]: r[1] for r in render_markdown(cells).collect()} == {1: "| a\\|b |  |\n| --- | --- |\n| c d | e |", 2: "| h |\n| --- |"}


def test_offsets_are_taken_by_count_unless_they_overlap(spark):
    from folioforge.operators.sequences import fit_offsets

    rows = [("b", 5, 10, 1, 20), ("b", 7, 9, 15, 40), ("b", 9, 8, 19, 60), ("b", 1, 2, 90, 99), ("c", 2, 4, 1, 4), ("c", 1, 4, 1, 4)]
    got = fit_offsets(spark.createDataFrame(rows, "book string, shift long, pages long, first long, last long")).orderBy("book", "shift").collect()
    # 7 has 6 of 26 places inside 5; 9 has 2 of 42; equal counts go to the least shift
    assert [tuple(r) for r in got] == [("b", 5, 10, 1, 20), ("b", 9, 8, 19, 60), ("c", 1, 4, 1, 4)]


def test_title_candidates_read_whole_titles(spark, tmp_path):
    from folioforge.plans import CATALOGUE
    from folioforge.plans import readings

    title = "abcd" + "efghijklm" * 4
    titles = [title, title + "n" * 30, title + "o" * 30, title, "abcx" + title[4:], title[:-12] + "p" * 12]
    spark.createDataFrame([(i, f"<h1>{t}</h1>") for i, t in enumerate(titles)], "page_id long, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    want = [(0, 3, 0), (0, 5, 12)]  # the first 40 letters of 0, 1 and 2 are equal, the whole titles are far apart
    was = readings.TITLES
    try:
        for readings.TITLES in (was, 1):
            assert sorted(map(tuple, CATALOGUE["title_candidates"].run(spark, str(tmp_path)).collect())) == want
    finally:
        readings.TITLES = was


def test_shared_cores_count_few_stretches(spark, monkeypatch):
    from collections import Counter

    from folioforge.operators import classes as cl

    # sorted, so that each part has stretches of its own, and one core is in half of the texts only
    rows = [("k", f"part {i // 40:03d} {'shared core' if i % 2 else 'x'} {i:05d}") for i in range(800)] + [("l", f"{i}same{i}") for i in range(5)]
    texts = spark.createDataFrame(rows, "k string, t string").repartitionByRange(7, "t")
    got = {tuple(r) for r in cl.shared_cores(texts, "k", "t").collect()}
    for g, core, n in got:
        own = [t for k, t in rows if k == g]
        counts = Counter(x for t in own for x in {t[i : i + k] for k in range(2, 25) for i in range(len(t) - k + 1)})
        top = max(counts.values())
        assert n == counts[core] and n >= 0.9 * top
        best = min((x for x, c in counts.items() if c == top), key=lambda x: (-len(x), x))
        assert best in core
    assert {g for g, _, _ in got} == {"k", "l"}
    # what is written on the way are a few stretches and not all of them
    sizes = []
    real = cl._written
    monkeypatch.setattr(cl, "_written", lambda df: (lambda x: sizes.append(x.count()) or x)(real(df)))
    cl.shared_cores(texts, "k", "t").collect()
    assert 0 < sizes[0] < 500
    assert cl.frequent_cores(["abcab", "xabc", "bc"], 2, 24, 2) == {"ab": 2, "bc": 3, "abc": 2}


def test_loop_periods_against_all_periods(monkeypatch):
    import random

    import numpy as np

    def every(text):
        x = np.array([ord(c) for c in text])
        out = []
        for p in range(1, 201):
            same = np.concatenate([[0], (x[p:] == x[:-p]).astype(int), [0]])
            edge = np.flatnonzero(np.diff(same))
            out += [(a, b + p, p) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a + p >= max(1000, 5 * p)]
        return sorted(out)

    random.seed(4)
    for _ in range(150):
        noise = lambda: "".join(random.choice("abcdef ") for _ in range(random.randint(0, 900)))
        unit = "".join(random.choice("abé") for _ in range(random.randint(1, 210)))
        text = noise() + unit * (random.randint(900, 1300) // len(unit)) + unit[: random.randint(0, len(unit))] + noise() + "xy" * random.randint(480, 520) + noise()
        assert sorted(lp._periodic_runs(text)) == every(text)
    # a text without loops is looked through by pieces, not once for each period
    looked = []
    real = np.flatnonzero
    monkeypatch.setattr(lp.np, "flatnonzero", lambda *a: looked.append(1) or real(*a))
    lp.find_loops("".join(random.choice("abcdefgh ") for _ in range(5000)))
    assert not looked


def test_edits_by_place_against_all_pairs():
    import random

    from folioforge.operators import edits as ed

    def slow(text, rows):
        taken, refused = [], 0
        for e in rows:
            if text[e[0] : e[1]] == e[2]:
                continue
            if any(ed.meet(*e[:2], *t[:2]) for t in taken):
                refused += 1
            else:
                taken.append(e)
        return sorted(taken, key=lambda e: e[:2]), refused

    random.seed(6)
    for _ in range(3000):
        text = "".join(random.choice("abé") for _ in range(random.randint(0, 30)))
        rows = [(a, a + random.choice((0, 0, 1, 2, 9)), random.choice(("", "x", "yyy", "a")), "R") for a in (random.randint(0, len(text)) for _ in range(random.randint(0, 12)))]
        rows = [(a, min(b, len(text)), x, r) for a, b, x, r in rows]
        assert ed.choose(text, rows) == slow(text, rows)
        done, n, _, log = ed.apply_to(text, rows)
        assert n == len(log) and ed.replay_text(text, [r[1:4] for r in log]) == (done, True)
        wild = [(random.randint(0, len(text) + 3), random.choice(("", "a", "ab")), random.choice(("", "z", "qq"))) for _ in range(5)]
        now, ok = text, True
        for at, before, after in wild:
            ok = ok and now[at : at + len(before)] == before
            now = now[:at] + after + now[at + len(before) :]
        assert ed.replay_text(text, wild) == (now, ok)


def test_edits_move_a_text_once(spark, tmp_path):
    from folioforge.plans import CATALOGUE

    spark.createDataFrame([(1, "Abcdefgh\n" * 100), (2, "x"), (3, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    q = CATALOGUE["edit_apply_replay"].run(spark, str(tmp_path))
    assert [tuple(r) for r in q.collect()] == [(1, 3, 0, True)]
    assert str(q._jdf.queryExecution().optimizedPlan()).count("Join") == 1


def test_coverage_against_sets(monkeypatch):
    import random

    import numpy as np

    from folioforge.functions import coverage as cv

    random.seed(5)
    for size, table, counts in ((4, 1 << 22, 1 << 22), (4, 0, 7), (12, 1 << 22, 1 << 22), (12, 0, 1)):
        monkeypatch.setattr(cv, "TABLE", table)
        monkeypatch.setattr(cv, "COUNTS", counts)
        monkeypatch.setattr(cv, "SLICE", 50)
        word = lambda n, some: "".join(random.choice(some) for _ in range(random.randint(0, n)))
        keys = [word(40, "ab字") for _ in range(30)] + ["ab", "a" * 50, ""]
        ids = [random.randint(100, 120) for _ in keys]
        docs = [word(60, "ab字c😀") for _ in range(60)] + keys
        pieces = lambda t: {t[i : i + size] for i in range(len(t) - size + 1)} or ({t} if len(t) >= 2 else set())
        want = {}
        for x in set(ids):
            own = set().union(*(pieces(k) for i, k in zip(ids, keys) if i == x))
            want |= {(d, x): (c, len(own)) for d, t in enumerate(docs) if (c := len(own & pieces(t)))}
        items = cv.Items(ids, keys, size)
        got = {(d, items.ids[i]): (c, int(items.n[i])) for part in items.counts(docs) for d, i, c in zip(*map(np.ndarray.tolist, part))}
        assert got == want
    assert list(cv.Items([], [], 4).counts(["abcd", ""]))[0][2].tolist() == []


def test_coverage_makes_no_row_for_a_piece(spark, tmp_path, monkeypatch):
    from folioforge.plans import CATALOGUE, pages

    spark.createDataFrame([(1, "abcdefghijklmnop"), (2, "ab"), (3, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(7, "xabcdefghijklmnop"), (8, "A-b"), (9, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for monkeypatched in (1 << 24, 5):
        monkeypatch.setattr(pages, "ITEM_CHARS", monkeypatched)
        for name in ("shingle_coverage", "shingle_coverage_fours"):
            q = CATALOGUE[name].run(spark, str(tmp_path))
            assert sorted(map(tuple, q.collect())) == [(1, 7, 1.0), (2, 8, 1.0)]
            assert "Generate" not in str(q._jdf.queryExecution().optimizedPlan())
        for name in ("unread_items", "unread_items_fours"):
            assert [tuple(r) for r in CATALOGUE[name].run(spark, str(tmp_path)).collect()] == [(3, 0.0)]


def test_edge_heads_of_odd_lines(spark):
    from folioforge.operators import furniture as fu

    texts = {1: "  \n\n  Head one\r\nx\n last  \n \n", 2: None, 3: "\n \n", 4: "only", 5: "\ta", 6: "a\n\nb "}
    pages = spark.createDataFrame([("b", k, t) for k, t in texts.items()], "book string, page long, text string")
    want = {k: ([x for x in (t or "").split("\n") if x.strip(" ")] or [None]) for k, t in texts.items()}
    assert {r.page: (r.first, r["last"]) for r in fu.edge_lines(pages).collect()} == {k: (v[0], v[-1]) for k, v in want.items()}
    # a carriage return is no letter, so "Title\r" is no stretch, and "Title" is one; numerals are folded
    rows = [("b", i, f"Title\r\ntext {i}\n{i} the end") for i in range(6)] + [("b", 9, "Titan\nx")]
    q = fu.edge_heads(spark.createDataFrame(rows, "book string, page long, text string"))
    assert sorted(map(tuple, q.collect())) == [("b", "end", "the end", 6), ("b", "start", "Title", 6)]
    assert "Generate" not in str(q._jdf.queryExecution().optimizedPlan())  # lines and stretches become no rows


def test_trees_leave_plain_texts_out(spark):
    import random

    from folioforge.operators import trees as tr

    random.seed(3)
    sign = lambda: random.choice(["- a", "  * b", "\t+ c", "1. d", "٣) e", "12.) f", "-", "- ", "x - y", "", "words.", "\r1. g", "4.\t h"])
    texts = ["\n".join(sign() for _ in range(random.randint(0, 4))) for _ in range(3 * tr.ROWS)]
    html = ["<p>x", "<UL><li>a<ul><li>b</ul></UL>", "<ol></ol>", ""]
    df = spark.createDataFrame([(i, t, html[i % 4]) for i, t in enumerate(texts)] + [(-1, None, None)], "i long, t string, h string").coalesce(1)
    q = df.select("i", tr.text_trees(F.col("t")).alias("a"), tr.html_trees(F.col("h")).alias("b"))
    plan = str(q._jdf.queryExecution().optimizedPlan())
    assert plan.count("RLIKE") == 2
    for r in q.collect():
        a, b = ([tuple(e) for e in x] for x in (r.a, r.b))
        assert a == (tr.item_edges(tr.text_items(texts[r.i])) if r.i >= 0 else [])
        assert b == (tr.item_edges(tr.html_items(html[r.i % 4])) if r.i >= 0 else [])


def test_shares_stay_in_arrow(spark):
    from folioforge.functions import novelty as nv

    rows = [(i, "abcdef\nx\nghij", "xabcdef" if i % 2 else None) for i in range(2 * nv.ROWS + 1)]
    df = spark.createDataFrame(rows, "i long, k string, b string").coalesce(1)
    q = df.select("i", nv.held_shares(F.col("k"), F.col("b")).alias("s"))
    assert {(r.i % 2, tuple(r.s)) for r in q.collect()} == {(0, (0.0, None, 0.0)), (1, (1.0, None, 0.0))}
    # strings for a whole batch, as pandas makes them, are what the memory went to
    from pyspark.util import PythonEvalType

    assert f", {PythonEvalType.SQL_SCALAR_ARROW_UDF}" in str(q._jdf.queryExecution().optimizedPlan())

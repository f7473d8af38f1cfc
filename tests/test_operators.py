"""Semantics that SQL cannot check: scanners, alignment, state on streams, sources and sinks."""

from __future__ import annotations

import zipfile
from collections import Counter

import pytest
from quire.functions import mathtext as M
from quire.operators import checks, generators, joins, lint, markup, records, windows
from quire.plans import pipelines
from quire.sources import readers, writers
from quire.streaming import events, state


@pytest.mark.parametrize(
    ("text", "bodies"),
    [("a $x$ \\$5 $y$", ["x", "y"]), ("$a\n\nb$ c$", [" c"]), (r"\[a\] \(b\) $$c$$", ["a", "b", "c"]), (r"\begin{align*}x\end{align*} $", ["x"]), ("$$ never", []), ("% $no$\n$y$", ["y"])],
)
def test_spans(text, bodies):
    found = [s.body for s in M.spans(text, latex=True)]
    assert found == bodies


@pytest.mark.parametrize(
    ("one", "other"),
    [
        (r"\dfrac{a}{b}", r"\frac ab"), (r"x^{\prime}", "x'"), (r"{{a b}}", "{a b}"), (r"\mathrm{sin}x", r"\sin x"), (r"a\times b", "a × b"), ("1 000", r"1{,}000"), (r"\left( x \right)", "(x)"),
        (r"a \text{if} b", "a b"), ("x_{1}", "x_1"), ("a=b,", "a=b"), (r"\begin{aligned}a&=b\\c&=d\end{aligned}", "a=b c=d"),
    ],
)
def test_equal_math(one, other):
    assert M.tokens(one) == M.tokens(other)


def test_numbers_and_tags():
    assert M.numbers(M.tokens("7^{-31}-w_{04}")) == ["7", "^-31", "_04"]
    assert M.bare(M.Span(True, r"a=b\tag{1 . 2}", 0, 0, "")) == ("a=b ", ["1.2"])
    assert M.bare(M.Span(True, "p=q (4.5)", 0, 0, "4.6"))[1] == ["4.5", "4.6"] and M.bare(M.Span(False, "(4.5)", 0, 0, ""))[1] == []
    assert M.argument(r"{a{b}\}c} d", 0) == (r"a{b}\}c", 9) and M.argument("{open", 0) is None


def test_fidelity_is_silent_about_formatting(spark):
    pairs = [("$\\dfrac{a}{b}\\le x$", "$\\frac ab \\leq x$"), ("$$a=b\\tag{1.1}$$", "\\begin{equation}a=b\\tag{1.1}\\end{equation}"), ("$$x'$$", "\\[x^{\\prime}\\]"), ("共 3 个", "3 in all")]
    frame = spark.createDataFrame([(str(k), *p) for k, p in enumerate(pairs)], "doc string, source string, target string")
    assert markup.pair_fidelity(frame).filter("severity = 'review'").count() == 0


def test_similarity_depends_on_order():
    assert joins.similarity(" ".join("tide"), " ".join("diet")) == 250_000
    assert joins.similarity(" ".join("diet"), " ".join("tide")) == 500_000


def test_one_to_one(spark):
    rows = [("b", 1, 1, 5, 10, 3), ("b", 2, 2, 5, 10, 0), ("b", 2, 2, 6, 11, 4)]
    frame = spark.createDataFrame(rows, "book string, old_pos long, old_id long, new_pos long, new_id long, distance long")
    assert sorted(map(tuple, joins.one_to_one(frame).collect())) == [("b", 1, 10, 3), ("b", 2, 11, 4)]


def test_tiles():
    assert windows.snapped_tiles(300, 120, 3, []) == [(1, 120), (118, 237), (235, 300)]
    assert windows.snapped_tiles(200, 100, 2, [96]) == [(1, 95), (94, 193), (192, 200)]
    with pytest.raises(ValueError, match="never advances"):
        windows.tiles(None, most=2, overlap=2)


def test_stream_gives_the_batch_fold(spark, sf_dir, tmp_path):
    found = state.chunk_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    found.repartition(3).write.parquet(str(tmp_path / "in"))
    schema = "chunk long, seq long, status string, error string"
    stream = state.stream_states(events.landing(spark, str(tmp_path / "in"), schema))
    query = stream.writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {tuple(r) for r in spark.table("states").collect()} >= {tuple(r) for r in state.folded(found).collect()}


def test_stream_windows(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    source.write.parquet(str(tmp_path / "in"))
    stream = events.window_counts(spark.readStream.schema(source.schema).parquet(str(tmp_path / "in")), "1 hour", late="1000 days")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("hours").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {tuple(r) for r in spark.table("hours").collect()} == {tuple(r) for r in events.window_counts(source, "1 hour").collect()}


def test_answers_arrive_once(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, answer string").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        state.upsert_stream(events.landing(spark, str(tmp_path / "in"), "id long, answer string"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_sources(spark, tmp_path):
    for folder, name, text in (("chunks", "001.md", "源"), ("chunks", "x.md", "y"), ("translated", "001.tex", "out")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text, encoding="utf-8")
    rows = {tuple(r) for r in readers.chunk_folder(spark, str(tmp_path)).collect()}
    assert rows == {("001", "源", "out"), ("x", "y", None)}
    assert readers.chunk_folder(spark, str(tmp_path), digits_only=True).count() == 1
    (tmp_path / "a.json").write_text('{"start": 2, "end": 9}')
    assert readers.page_ranges(readers.json_documents(spark, str(tmp_path / "a.json"), readers.PAGE_RANGE), page_count=10).first()["confidence"] == "medium"
    with pytest.raises(Exception, match="bad page range"):
        readers.page_ranges(readers.json_documents(spark, str(tmp_path / "a.json"), readers.PAGE_RANGE), page_count=5).collect()
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        z.writestr("auto.md", "no")
        z.writestr("d/full.md", "yes")
    assert readers.archive_texts(readers.archive_members(spark, str(tmp_path / "p.zip"))).first()["text"] == "yes"
    (tmp_path / "i.png").write_bytes(bytes.fromhex("89504E470D0A1A0A00"))
    assert readers.images(spark, str(tmp_path / "i.png")).first()["kind"] == "image/png"


def test_sinks(spark, tmp_path):
    builds = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 1, False)], "book string, seq long, succeeded boolean")
    outputs = spark.createDataFrame([("a", "p", 5, 4), ("b", "q", 5, 4), ("a", "old", 3, 4)], "book string, path string, made long, source_changed long")
    assert writers.publish(builds, outputs, str(tmp_path / "out")) and [r["path"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["p"]
    references = spark.createDataFrame([("d", "images/x.png")], "doc string, path string")
    files = spark.createDataFrame([("images/y.png",)], "file string")
    with pytest.raises(ValueError, match="missing images"):
        writers.package(references, files, builds, str(tmp_path / "kit"))


def test_lint_and_prepare(spark):
    source = spark.createDataFrame([("001", "$$a-b$$"), ("002", "x")], "doc string, text string")
    target = spark.createDataFrame([("001", "$$a+b$$ \\begin{foo}")], "doc string, text string")
    waivers = spark.createDataFrame([(1, "*", "foo", "a known macro"), (2, "environment-balance", "foo", "known too")], "pos int, check string, excerpt string, reason string")
    found = {r["check"] for r in pipelines.lint(source, target, waivers).collect()}
    assert found == {"missing-translation", "changed-block"}
    books = spark.createDataFrame([("b", "# Chapter 1\n\n# Motion\n\n![f](a.png)\ntext")], "doc string, text string")
    chunks, tokens = pipelines.prepare(books, spark.createDataFrame([], "title string, level int"), most=20)
    assert chunks.count() == 2 and [tuple(r) for r in tokens.collect()] == [("b", "a.png", "IMG_0001")]
    assert writers.gate(spark, pipelines.lint(source, target, waivers)) == 1


def test_spec_status(spark):
    rows = [("a", "overlay", [("力", "force", [0.1, 0.1, 0.2, 0.2])], None, None, None)]
    frame = spark.createDataFrame(rows, "image string, method string, labels array<struct<zh:string,en:string,box:array<double>>>, accepted boolean, rendered string, error string")
    assert records.spec_status(frame).first()["status"] == "todo"


def test_cap(spark):
    rows = [("d", "c", "review", f"m{k}", k, "") for k in range(30)]
    assert checks.capped(spark.createDataFrame(rows, checks.FINDING)).count() == checks.MAX_EXAMPLES


def test_surface_is_in_order(spark):
    """All checks of both sides run, and those without their dimension are left out."""
    docs = spark.createDataFrame([("d", "\\chapter{1 A}\n$x\\textcircled{1}$ \\foo \\multirow\n\\includegraphics{a.png}\n日\u200b"), ("e", ""), ("f", None)], "doc string, text string")
    names = lambda *xs: spark.createDataFrame([(x,) for x in xs], "word string")
    known = lint.Dimensions(
        names("chapter", "textcircled", "includegraphics", "multirow"), names("frac").toDF("command"), spark.createDataFrame([("multirow", "multirow")], "command string, provider string"), names("images/b.png").toDF("file"),
    )
    found = {(r["rank"], r["check"]) for r in lint.surface(docs, lint.LATEX, known).collect()}
    assert found == {(2, "unicode-character"), (2, "zero-width-character"), (7, "duplicated-number"), (12, "unknown-command"), (13, "text-command-in-math"), (14, "missing-package"), (16, "image-path")}
    assert {r["check"] for r in lint.surface(docs, lint.LATEX).collect()} == {c for k, c in found if k not in (12, 14, 16)}
    source = spark.createDataFrame([("s", "$$$$ \\$5 ![f](x.png)\n$ y$\n<table><tr><td colspan=2>a</td></tr></table>")], "doc string, text string")
    assert {r["rank"] for r in lint.surface(source, lint.MARKDOWN, known).collect()} >= {0, 3, 4, 11, 12}


def test_overwrite_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite(spark.range(5), path)
    with pytest.raises(Exception, match="boom"):
        writers.overwrite(spark.range(3).selectExpr("raise_error('boom') AS id"), path)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "t.old").exists()
    writers.overwrite(spark.read.parquet(path).filter("id > 2"), path)
    assert spark.read.parquet(path).count() == 2
    sheet = writers.review_sheet(spark.createDataFrame([(1, "a<b", True, ["gap"]), (2, "c", False, [])], "position int, name string, keep boolean, flags array<string>"), "Book & co").first()["html"]
    assert sheet.startswith("<!doctype html>") and sheet.index("<td>2</td>") < sheet.index("a&lt;b") and "Book &amp; co" in sheet


def test_similar_compares_kinds(spark, monkeypatch):
    """Lists with the same bag are compared once and written out in cells; no pair is lost or twice."""
    monkeypatch.setattr(joins, "CELL", 7)
    lists = [(k % 2, k, [f"a{k % 3}", "b", "b", "c", f"d{k % 2}"]) for k in range(300)] + [(0, 300, []), (0, 301, None), (0, 302, ["b", "c", "b", "a1", "d0"])]
    frame = spark.createDataFrame(lists, "g int, id long, tokens array<string>")
    members, kinds = joins._kinds(frame, ["g"])
    assert kinds.filter("size(tokens) > 0").count() == 6 and members.groupBy("g", "kind", "cell").count().agg({"count": "max"}).first()[0] < 50
    found = [tuple(r) for r in joins.similar(frame, frame, ["g"], least=0.8).collect()]

    def bag(x, y):
        return 2 * sum((Counter(x) & Counter(y)).values()) / (len(x) + len(y))

    assert sorted(found) == sorted((g, i, j, bag(x, y)) for g, i, x in lists for h, j, y in lists if g == h and x and y and bag(x, y) >= 0.8)


def test_located_sends_nothing_through_the_driver(spark):
    rows = spark.range(100).selectExpr("id AS doc", "1L AS page", "concat('page of ', id) AS text")
    excerpts = rows.selectExpr("doc", "1L AS id", "1L AS first", "1L AS last", "text AS excerpt")
    plan = records.located(excerpts, rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_located_on_long_pages(spark):
    """A passage with one letter off is found however long its page is."""
    excerpts = spark.createDataFrame([("d", 1, 1, 1, "the tide was rising fast")], "doc string, id long, first long, last long, excerpt string")
    pages = spark.createDataFrame([("d", 1, "x " * 400), ("d", 5, "and so on " * 300 + "the tide was rising last" + " it went on" * 300)], "doc string, page long, text string")
    assert [tuple(r) for r in records.located(excerpts, pages).collect()] == [("d", 1, [5], "fuzzy")]


def test_spans_and_paragraphs_stay_in_their_row(spark):
    """No shuffle of spans, so none that brings all spans without a command to one task; a fence that is never closed, no text and blank ends count."""
    texts = ["a $x$\n$$\nb\n\nc \\frac \n $$ \n$$d$$ and $ e$", "$$\nopen \\sqrt", "$$\n$$", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    spans = generators.math_spans(docs)
    assert sorted(tuple(r) for r in spans.collect()) == [
        (0, 1, 0, "inline", "x"), (0, 2, 0, "display", "b\n\nc \\frac "), (0, 7, 0, "display", "d"), (0, 7, 1, "inline", " e"), (1, 1, 0, "display", "open \\sqrt"), (2, 1, 0, "display", ""),
    ]
    found = checks.dangling(spans, spark.createDataFrame([("frac",), ("sqrt",), ("sqrt",)], "command string"))
    assert sorted((r["doc"], r["command"]) for r in found.collect()) == [(0, "frac"), (1, "sqrt")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(doc" not in plan and "Window" not in plan
    placed = checks.placed_paragraphs(docs.filter("doc = 0").selectExpr("doc", "'a\nb\n \n\nc\n\nd' AS text"))
    assert [tuple(r) for r in placed.orderBy("nth").collect()] == [(0, 0, "a\nb", 1), (0, 1, "c", 4), (0, 2, "d", 6)]


def test_fidelity_reads_each_span_once(spark, monkeypatch):
    """Tokens are the dear part of a pair; the findings do not depend on how often they are read."""
    read = []
    monkeypatch.setattr(M, "tokens", lambda body, plain=M.tokens: (read.append(body), plain(body))[1])
    monkeypatch.setattr(markup, "mapped", lambda docs, columns, schema, rows: list(rows("$$a-b$$ (1.2)\n\n$$c$$ $d$ 3.5", "$$a+b$$\n\n$$c$$ $d$ % 3.5")))
    assert markup.pair_fidelity(None) == [("equation-tags", "review", "lost 1.2"), ("changed-block", "review", "a - b"), ("prose-numbers", "info", "1.2"), ("prose-numbers", "info", "3.5")]
    assert sorted(read) == sorted(["a-b", "c", "d", "a+b", "c", "d"])


def test_surface_meets_no_text_again(spark):
    """Lines come with the arguments, not by a join with all texts, and what documents are left out beforehand has no finding."""
    docs = spark.createDataFrame([("a", "x\n\\section*{1 A}"), ("b", "$a\\$$x$$frac$"), ("c", "$\\t$$x$$ag{1}\\tag{2}$ $$\\frac$$"), ("d", "$$\nq \\sqrt \n$$"), ("e", "\\[y \\frac\\]"), ("f", None)], "doc string, text string")
    starred = lint.starred_numbers(docs)
    assert [tuple(r) for r in starred.collect()] == [("a", "section", "1 A", 2)] and "Join" not in starred._jdf.queryExecution().executedPlan().toString()
    known = lint.Dimensions(arguments=spark.createDataFrame([("frac",), ("sqrt",)], "command string"))
    found = {side: {(r["doc"], r["check"]) for r in lint.surface(docs, order, known).collect()} for side, order in (("md", lint.MARKDOWN), ("tex", lint.LATEX))}
    assert {d for d, c in found["md"] if c == "dangling-command"} == {"b", "c", "d"} and ("c", "multiple-tags") in found["md"]
    assert {d for d, c in found["tex"] if c == "dangling-command"} == {"b", "c", "d", "e"}

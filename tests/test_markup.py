"""The page automaton against a plain tree walk, and how pages are dealt to tasks."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from finloom.catalog.registry import Tables
from finloom.operators.markup import NOT_TEXT, VOID, PageRules, Step, Take, page_rows, read_page
from finloom.plans import articles, calendar
from finloom.sources import readers


class Tree(HTMLParser):
    """The page as nested lists: [tag, attributes, children], with text runs among the children."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.top = ["", {}, []]
        self.open = [self.top]
        self.fresh = True
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = [tag, {k: v or "" for k, v in attrs}, []]
        self.open[-1][2].append(node)
        if tag not in VOID:
            self.open.append(node)
        self.fresh = True

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                break
        self.fresh = True

    def handle_data(self, data):
        inside = self.open[-1][2]
        if self.fresh:
            inside.append(data)
        else:
            inside[-1] += data
        self.fresh = False

    def handle_comment(self, data):
        self.fresh = True

    handle_decl = handle_pi = handle_comment


def below(node):
    for child in node[2]:
        if isinstance(child, list):
            yield child
            yield from below(child)


def fits(node, step):
    classes = node[1].get("class", "").split()
    return (
        step.tag in (None, node[0])
        and step.id in (None, node[1].get("id"))
        and all(c in classes for c in step.classes)
        and (step.class_part is None or any(step.class_part in c for c in classes))
    )


def matches(node, path, any_branch):
    hits = [n for n in below(node) if fits(n, path[0])]
    if len(path) > 1:
        hits = [m for n in (hits if any_branch else hits[:1]) for m in matches(n, path[1:], any_branch)]
    return [n for k, n in enumerate(hits) if all(n is not m for m in hits[:k])]


def runs(node):
    for child in node[2]:
        if isinstance(child, str):
            yield child
        elif child[0] not in NOT_TEXT:
            yield from runs(child)


def string(node, kind):
    if kind in ("raw", "text"):
        joined = "".join(runs(node))
        return joined if kind == "raw" else joined.strip()
    return ("\n" if kind == "lines" else "").join(r.strip() for r in runs(node) if r.strip())


def plain_page(html, rules):
    top = Tree(html).top
    out = []
    for row in matches(top, rules.rows, True) if rules.rows else [top]:
        fields = {}
        for name, take in rules.fields.items():
            hits = matches(row, take.path, take.any_branch)
            if take.kind == "count":
                fields[name] = len(hits)
            elif take.kind.startswith("all"):
                fields[name] = [string(n, take.kind.removeprefix("all ")) for n in hits]
            elif take.kind == "attribute":
                fields[name] = hits[0][1].get(take.attribute) if hits else None
            else:
                fields[name] = string(hits[0], take.kind) if hits else None
        out.append(fields)
    return out


RULES = [
    calendar.EVENT_RULES,
    calendar.EARNING_RULES,
    articles.ARTICLE_RULES,
    articles.LISTING_RULES,
    PageRules(
        {
            "first": Take((Step("div"), Step("a")), "all raw"),
            "any": Take((Step("div"), Step("div"), Step(classes=("x",))), "all lines", any_branch=True),
            "count": Take((Step("div"), Step("b")), "count"),
            "hidden": Take((Step("template"), Step("a")), "text"),
        },
        rows=(Step("tr"),),
    ),
    PageRules({"every": Take((Step(),), "count"), "cells": Take((Step("td"),), "all tight")}, rows=(Step("div"), Step("tr"))),
]
TAGS = "div tr td a b span i img br table tbody time p template".split()
CLASSES = ["x", "js-event-item", "left flagCur noWrap", "left noWrap earnCalCompany", "event", "act", "flag", "article-wrap", "byline-attr-author z", "body-wrap", "content", "footer", "publishing", ""]


def random_page(rng):
    out = []
    for _ in range(rng.randrange(35)):
        if rng.random() < 0.5:
            attrs = "".join(rng.choice(forms) for forms in (["", f' class="{rng.choice(CLASSES)}"', f" CLASS='{rng.choice(CLASSES)}'"], ["", "", ' id="earningsCalendarData"', " title='a>b'", " title=q", ' href="T &amp; t"', " alt"]))
            out.append(f"<{rng.choice(TAGS)}{attrs}{rng.choice(['', ' ', '/'])}>")
        else:
            out.append(rng.choice([f"</{rng.choice(TAGS)}>", " a ", "b &amp; c", "\n", "&nbsp;", "x < y", "<!-- c -->", "<!DOCTYPE html>", "<script>var x='<p>';</script>", "</ div>"]))
    return "".join(out)


def test_the_automaton_reads_what_a_tree_walk_reads():
    rng = random.Random(6)
    for _ in range(4000):
        html = random_page(rng)
        for rules in RULES:
            assert read_page(html, rules) == plain_page(html, rules), html


def test_odd_pages():
    rows = PageRules({"t": Take((Step("td"),))}, rows=(Step("tr"),))
    assert read_page(None, rules=rows) == read_page("", rows) == read_page("no rows < here", rows) == []
    assert read_page("<tr><td>" + "x" * 300_000 + "<tr><td>y", rows) == [{"t": "x" * 300_000 + "y"}, {"t": "y"}]
    assert read_page("<tr><td>" * 400, rows)[0] == {"t": ""}


@pytest.mark.parametrize("name, key", [("events", "event_id"), ("orders", "o_orderkey")])
def test_narrow_tables_are_dealt_to_every_core_before_they_grow(spark, name, key):
    cores = spark.sparkContext.defaultParallelism
    dealt = Tables(spark, "/root/testdata/sf0.01").spread(name, key)
    wide = dealt.select(page_rows(F.lit("<tr class='js-event-item'><td class='time'>1"), calendar.EVENT_RULES).alias("r"), F.spark_partition_id().alias("task"))
    assert wide.where("size(r) = 1").select("task").distinct().count() >= cores


def test_pages_of_one_file_are_dealt_to_every_core(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    pages = spark.range(500).select(F.col("id").cast("string").alias("url"), F.lit("x").alias("timestamp"), F.lit("<p>").alias("content"))
    pages.coalesce(1).write.json(f"{tmp_path}/one")
    pages.repartition(2 * cores).write.json(f"{tmp_path}/many")
    one, many = (spark.read.schema(pages.schema).json(f"{tmp_path}/{n}") for n in ("one", "many"))
    assert readers.spread_pages(one).select(F.spark_partition_id().alias("p")).distinct().count() == cores
    assert "Exchange" not in readers.spread_pages(many)._jdf.queryExecution().executedPlan().toString()


def test_the_text_of_a_tag_is_read_once(monkeypatch):
    from finloom.operators import markup

    met = []
    monkeypatch.setattr(markup, "_read_tag", lambda text, read=markup._read_tag: met.append(text) or read(text))
    rules = PageRules({"once": Take((Step("u", ("k",)),)), "count": Take((Step("u"),), "count")}, rows=(Step("ol"), Step("li")))
    page = "<ol>" + '<li><u class="k">a &amp; b</u><u>c</u><hr></li>' * 50 + "</ol>"
    for _ in range(2):
        assert read_page(page, rules) == [{"once": "a & b", "count": 2}] * 50
    assert sorted(met) == sorted(["ol", "li", 'u class="k"', "/u", "u", "hr", "/li", "/ol"])


def test_rows_of_many_pages_are_handed_on_in_steps(spark, monkeypatch):
    from finloom.operators import markup

    monkeypatch.setattr(markup, "_MOST_ROWS", 7)
    rules = PageRules({"t": Take((Step("td"),))}, rows=(Step("tr"),))
    html = F.expr("concat_ws('', transform(sequence(1, id), i -> concat('<tr><td>', id, '-', i, '</td></tr>')))")
    pages = spark.range(1, 41, 1, 1).select("id", F.when(F.col("id") % 9 != 0, html).alias("html"))
    got = pages.select("id", page_rows(F.col("html"), rules).alias("r")).collect()
    assert [(r.id, [x.t for x in r.r]) for r in got] == [(n, [f"{n}-{i}" for i in range(1, n + 1)] if n % 9 else []) for n in range(1, 41)]

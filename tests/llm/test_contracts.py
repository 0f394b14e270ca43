"""Every registered query against plain Python on the smallest data."""

import html
import re

import pytest

from tallygrove.llm import quality_rules
from tallygrove.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def tables(spark):
    names = ("documents", "pages", "benchmark", "labels")
    return {n: spark.read.parquet(f"{SMALL}/{n}.parquet").collect() for n in names}


@pytest.fixture(scope="module")
def texts(tables):
    return {r.doc_id: r.text for r in tables["documents"]}


def result(spark, name, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, SMALL).collect()}


def test_line_dedup(spark, texts):
    wanted = brute.line_dedup(list(texts.items()), 50)
    got = result(spark, "op1_line_dedup")
    assert {i: (r.text, r.n_removed_lines) for i, r in got.items()} == wanted
    assert any(n for _, n in wanted.values())


def test_secret_scan(spark, texts):
    got = result(spark, "op2_secret_scan")
    for i, text in texts.items():
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == brute.secrets(text)


def test_mixing(spark, tables, texts):
    got = result(spark, "op3_mixing")
    source = {r.doc_id: r.source for r in tables["documents"]}
    sizes = {}
    for i, text in texts.items():
        assert got[i].size == len(brute.words(text))
        sizes[source[i]] = sizes.get(source[i], 0) + got[i].size
    targets = brute.targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for i, r in got.items():
        assert r.source_size == sizes[source[i]]
        assert r.target == pytest.approx(targets[source[i]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[i]] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 1
    again = result(spark, "op3_mixing")
    assert again == got


def test_html_extract(spark, tables):
    got = result(spark, "op4_html_extract", "page_id")
    for page in tables["pages"]:
        article = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        plain = (" ".join(html.unescape(re.sub("<[^>]*>?", "", b)).split()) for b in blocks)
        row = got[page.page_id]
        assert row.text == "\n".join(b for b in plain if b)
        assert row.n_chars == len(row.text) and row.url == page.url


def test_quality_classifier(spark, tables, texts):
    got = result(spark, "op5_quality_classifier")
    assert set(got) == set(texts)
    assert all(r.held_out == brute.held_out(i) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    known = [r for r in tables["labels"] if r.quality is not None]
    right = [got[r.doc_id].predicted == r.quality for r in known if got[r.doc_id].held_out]
    assert sum(right) >= 0.9 * len(right)


def test_simhash(spark, texts):
    prints = {i: brute.simhash(t) for i, t in texts.items()}
    wanted = brute.linked(prints)
    got = result(spark, "op6_simhash_dedup")
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == wanted


def test_personal_data(spark, texts):
    got = result(spark, "op7_pii")
    for i, text in texts.items():
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == brute.personal(text)


def test_url_filter(spark, tables):
    got = result(spark, "op8_url_filter", "page_id")
    for page in tables["pages"]:
        r = got[page.page_id]
        assert (r.host, r.path, r.rule) == brute.url_rule(page.url)
        assert r.verdict == brute.RULES[r.rule] if r.rule else r.verdict in ("allow", "block")


def test_quality_rules(spark, texts):
    got = result(spark, "op9_quality_rules")
    for i, text in texts.items():
        for name, value in brute.quality(text).items():
            assert got[i][name] == value, name
        assert not (got[i].kept and got[i].base_failed)


def test_policies_and_ablations(spark):
    """Both over the whole table, against the ledger that op9 returns."""
    rows = result(spark, "op9_quality_rules")
    policies = result(spark, "op9_policies")
    table = {(r.policy, r.version, r.rule): r for r in QUERIES["op9_ablations"](spark, SMALL).collect()}
    assert len(table) == sum(len(p.rules) for p in quality_rules.POLICIES)
    for p in quality_rules.POLICIES:
        hits = {i: r.failed_bits & p.mask() for i, r in rows.items()}
        assert {i: r[f"kept_{p.name}_v{p.version}"] for i, r in policies.items()} == {i: not h for i, h in hits.items()}
        for rule in (r for r in quality_rules.RULES if r.name in p.rules):
            bit, got = 1 << rule.bit, table[p.name, p.version, rule.name]
            assert got.n_failed == sum(bool(h & bit) for h in hits.values())
            assert got.n_only_this == sum(h == bit for h in hits.values())
            assert got.n_kept == sum(not h for h in hits.values())
            assert got.n_kept_without == sum(not h & ~bit for h in hits.values())


def test_decontaminate(spark, tables, texts):
    items = [(r.item_id, r.text) for r in tables["benchmark"]]
    wanted = brute.contamination(list(texts.items()), items)
    got = result(spark, "op10_decontaminate")
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert {i: tuple(r[n] for n in names) for i, r in got.items()} == wanted
    assert any(w[1] for w in wanted.values())


def test_native_queries_run_no_python(spark):
    from tests.conftest import plan_of

    for name in ("op1_line_dedup", "op9_quality_rules"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert not re.search("Python|Pandas|Arrow", plan)

"""Templates of large hosts and of segments without labels."""

from __future__ import annotations

from velotide.llm import url_templates


def judged(spark, pages, labels):
    pages = spark.createDataFrame([(i, u) for i, u, _ in labels] + pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, _, b in labels], "page_id long, bad int")
    return {r["page_id"]: r for r in url_templates.judged(pages, labels, []).collect()}


def test_unlabelled_siblings_do_not_share_a_labelled_verdict(spark):
    labels = [(i, f"http://h.org/spam/x{i}", int(i % 10 > 0)) for i in range(500)]
    labels += [(1000 + i, f"http://clean.org/a/x{i}", 0) for i in range(1500)]
    pages = [(5000 + i, f"http://h.org/blog/x{i}") for i in range(20)]
    found = judged(spark, pages, labels)
    assert {found[i]["verdict"] for i in range(500)} == {"block"}
    assert {found[5000 + i]["verdict"] for i in range(20)} == {"allow"}
    assert found[5000]["purity"] < 0.3


def test_a_bad_section_stays_apart_among_many(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    labels = [(1000 * k + i, f"http://h.org/{c}/x", 0) for k, c in enumerate(letters) for i in range(20)]
    labels += [(10**6 + i, "http://h.org/spam/x", 1) for i in range(2000)]
    unlabelled = [(2 * 10**6 + i, f"http://h.org/z{letters[i]}/x") for i in range(26)]
    found = judged(spark, unlabelled, labels)
    assert all(r["verdict"] == "allow" for i, r in found.items() if i < 10**6)
    assert all(r["verdict"] == "block" for i, r in found.items() if 10**6 <= i < 2 * 10**6)
    # Too many segments without labels are one, but not one with labelled siblings.
    assert {found[i]["template"] for i, _ in unlabelled} == {"/*/x"}
    assert {r["template"] for i, r in found.items() if i < 2 * 10**6}.isdisjoint({"/*/x"})


def test_one_section_more_changes_no_verdict(spark):
    """Sections of one bad label each are judged together, however many they are."""
    letters = [a + b for a in "abcde" for b in "fghijk"]
    clean = [(10_000 + i, f"http://clean.org/a/x{i}", 0) for i in range(300)]
    verdicts = {}
    for n in (6, 20, 21, 30):
        bad = [(i, f"http://h.org/{s}/x", 1) for i, s in enumerate(letters[:n])]
        found = judged(spark, [(999, "http://h.org/unknown/x")], bad + clean)
        verdicts[n] = {found[i]["verdict"] for i in [*range(n), 999]}
        assert {found[10_000 + i]["verdict"] for i in range(300)} == {"allow"}
    assert verdicts == dict.fromkeys((6, 20, 21, 30), {"block"})

"""Hosts that link only to blocked hosts are blocked, however many they are."""

import pytest

from postroad.llm import url_filter

RULES = [("spam.net", "/", "block"), ("good.com", "/", "allow")]


@pytest.mark.parametrize("members", [1, 10, 1000])
def test_a_farm_of_any_size_is_blocked(spark, members):
    link = lambda *hosts: "".join(f'<a href="http://{h}/p">' for h in hosts)
    bad = [f"s{k}.spam.net" for k in range(5)]
    urls = [(f"x://{h}/", "") for h in bad] + [(f"x://farm{k}.org/", link(*bad)) for k in range(members)]
    clean = {"good.com": link(bad[0]), "plain.org": "", "linked.org": "", "mostly.org": link(bad[0], "linked.org", "plain.org"), "friend.org": link("good.com", "linked.org"), "hub.org": link("only.spam.net", *(f"n{k}.org" for k in range(20)))}
    urls += [("x://only.spam.net/", link("linked.org"))] + [(f"x://{h}/", html) for h, html in clean.items()] + [("x://second.org/", link("farm0.org"))]
    pages = spark.createDataFrame([(k, *u) for k, u in enumerate(urls)], "page_id long, url string, html string")
    found = {r.host: r for r in url_filter.judge(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()}
    assert {h for h, r in found.items() if r.verdict == "allow"} == set(clean)
    assert found["farm0.org"].suspicion == pytest.approx(0.85) and found["second.org"].suspicion == pytest.approx(0.85**2)
    assert found["hub.org"].suspicion == pytest.approx(0.85 / 21)


def test_scores_are_moved_on_until_they_settle(spark):
    """A chain of 40 hosts before a blocked one: distrust reaches the first of them."""
    links = spark.createDataFrame([(f"h{k}", f"h{k + 1}", 1) for k in range(40)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("distrust", "h40", 1.0), *(("neutral", f"h{k}", 1.0) for k in range(40))], "kind string, host string, mass double")
    found = {(r.kind, r.host): r.score for r in url_filter.propagate(links, seeds).collect()}
    for k in (0, 10, 30, 39):
        assert found["suspicion", f"h{k}"] == pytest.approx(0.85 ** (40 - k), abs=1e-4)
        assert found["distrust", f"h{k}"] == pytest.approx(0.15 * 0.85 ** (40 - k) / 41, abs=1e-6)
    with pytest.raises(RuntimeError):
        url_filter.propagate(links, seeds, steps=20)

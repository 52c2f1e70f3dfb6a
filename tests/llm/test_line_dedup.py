from __future__ import annotations

from pitsync.llm.line_dedup import drop_site_lines

PAGES = "page_id long, url string, html string, host string, drop int"


def site(n, of, common):
    return [(n * 100 + k, f"http://{of}/x{k}", f"<p>{common}</p><p>own {n} {k}</p>", "q", 1) for k in range(10)]


def test_lines_above_the_ratio_go_per_host(spark):
    rows = site(1, "A.com", "menu") + site(2, "b.com:80", "menu") + site(3, "u@c.com", "other")
    rows += [(900, "http://one.com", "<p>menu</p>", "q", 1)]
    out = {r["page_id"]: r for r in drop_site_lines(spark.createDataFrame(rows, PAGES), max_ratio=0.5).collect()}
    assert out[101]["text"] == "own 1 1" and out[101]["host"] == "a.com" and out[101]["n_dropped"] == 1
    assert out[301]["host"] == "c.com" and out[201]["host"] == "b.com"
    assert out[900]["text"] == "menu"


def test_a_ratio_just_reached_stays_and_repeats_count_once(spark):
    rows = [(k, "http://a.b/", "<div>x</div><div>x</div>" if k < 5 else "<div>y&amp;&lt;</div>", "q", 1) for k in range(10)]
    out = {r["page_id"]: r for r in drop_site_lines(spark.createDataFrame(rows, PAGES), max_ratio=0.5).collect()}
    assert out[0]["text"] == "x\nx" and out[9]["text"] == "y&<"
    out = {r["page_id"]: r for r in drop_site_lines(spark.createDataFrame(rows, PAGES), max_ratio=0.49).collect()}
    assert out[0]["text"] == "" and out[0]["n_dropped"] == 2 and out[0]["n_lines"] == 2


def test_nulls_blank_pages_long_pages_and_no_rows(spark):
    long = "<p>" + "word " * 100_000 + "</p>"
    rows = [(None, None, None, None, None), (1, "no url", "", "q", 1), (2, "http://l.com", long, "q", 1), (2, "http://l.com", long, "q", 1)]
    rows += [(3, "http://s.com", "<script>if (a<b) {}</script><style>p{}</style><!-- <p>no</p> --> a<b>c</b>\n\n d ", "q", 1)]
    out = {r["page_id"]: r for r in drop_site_lines(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[None]["n_lines"] == 0 and out[None]["host"] == "" and out[1]["text"] == ""
    assert out[2]["n_lines"] == 1 and out[3]["text"] == "ac\nd"
    assert drop_site_lines(spark.createDataFrame([], PAGES)).count() == 0

"""A link's target is the host that a page with that address has."""

from tarmac.llm import urlgraph


def test_targets_are_cut_like_hosts(spark):
    urls = ["http://a.com:8080/x", "https://B_c.de?q", "//bücher.example/y", "http://plain.com#z", "http://last.com"]
    html = "".join(f'<a href="{u}">x</a>' for u in urls) + "<img src=http://bare.com>" + "<a href='http://one.com'>"
    edges = urlgraph.host_edges(spark.createDataFrame([("me.com", html)], "host string, html string")).collect()
    assert {r.dst for r in edges} == {"a.com:8080", "b_c.de", "bücher.example", "plain.com", "last.com", "bare.com", "one.com"}


def test_a_host_in_plain_text_is_no_link(spark):
    pages = spark.createDataFrame([("me.com", "<p>&copy; other.com</p> see http://third.com <a href='/own'>x</a>")], "host string, html string")
    assert urlgraph.host_edges(pages).count() == 0

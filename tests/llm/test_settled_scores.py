"""Link scores are those of settled rounds, however far a host is from a seed."""

import numpy as np

from tarmac.llm import queries, urlgraph


def _chain(spark, n):
    # host k links to host k + 1, the last one to a blocked host
    pages = [(k, f"http://h{k}.com/", f'<a href="http://{f"h{k + 1}.com" if k + 1 < n else "bad.net"}/">x</a>') for k in range(n)]
    return spark.createDataFrame([*pages, (n, "http://bad.net/", "")], "page_id int, url string, html string")


def test_distrust_goes_all_the_way_back(spark):
    rows = {r.page_id: r for r in urlgraph.judge(_chain(spark, 18), queries.RULES).collect()}
    assert all(rows[k].verdict == "block" and rows[k].distrust > 0 for k in range(18))


def test_settled_scores_solve_the_equation(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 1), ("d", "a", 3)]
    hosts = "abcd"
    m = np.zeros((4, 4))
    for s, t, k in edges:
        m[hosts.index(t), hosts.index(s)] = k / sum(x for y, _, x in edges if y == s)
    want = np.linalg.solve(np.eye(4) - 0.85 * m, 0.15 * np.array([0.25, 0, 0, 0.75]))
    out = urlgraph.propagate(
        spark.createDataFrame([("trust", *e) for e in edges], "kind string, src string, dst string, links int"),
        spark.createDataFrame([("trust", "a", 1.0), ("trust", "d", 3.0)], "kind string, host string, weight double"), rounds=None).collect()
    assert np.allclose([{r.host: r.score for r in out}[h] for h in hosts], want, atol=1e-7)

"""A search with the registered share of cells still finds k entries where there are so many."""

import numpy as np

from tarmac.llm import ann


def test_search_finds_k_with_few_cells(spark):
    rng = np.random.default_rng(5)
    # 15 distinct vectors; then a hot one that is the last for the queries, beside three small cells
    spread = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(15, 4)))]
    hot = [(0, [1.0, 0.0, 1.0, 0.0]), (1, [1.0, 0.0, 0.9, 0.1]), (2, [0.9, 0.1, 1.0, 0.0])] + [(10 + k, [-1.0, -1.0, -1.0, -1.0]) for k in range(40)]
    copies = [(0, [1.0, 0.0, 1.0, 0.0])] * 30 + hot[1:]
    for rows, k in ((spread, 20), (hot, 20), (copies, 20)):
        index = ann.build(spark.createDataFrame(rows, "vec_id long, vector array<double>"), dims=4)
        asked = index.entries.where("vec_id = 0").limit(1)
        got = {r.vec_id: r.score for r in ann.search(index, asked, k=k).collect()}
        mine = dict(rows)[0]
        scores = sorted((-sum(a * b for a, b in zip(mine, v, strict=True)), i) for i, v in rows if i != 0)[:k]
        assert sorted(got) == sorted(i for _, i in scores)

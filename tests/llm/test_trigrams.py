"""The trigram query against plain counts."""

import math
import re
from collections import Counter

from simlane.llm import queries


def test_trigram_query(spark, small):
    docs = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    own = {i: Counter(tuple(w[j : j + k]) for k in (1, 2, 3) for j in range(len(w) - k + 1)) for i, w in docs.items()}
    every = sum(own.values(), Counter())
    words = sum(map(len, docs.values()))

    def score(i, gram):
        n = every[gram] - own[i][gram]
        if len(gram) == 1:
            return math.log(max(n, 0.5) / (words - len(docs[i])))
        return math.log(n / (every[gram[:-1]] - own[i][gram[:-1]])) if n else math.log(0.4) + score(i, gram[1:])

    got = {r["doc_id"]: r["log_score"] for r in queries.QUERIES["op1_stupid_backoff"](spark, small).collect()}
    assert set(got) == set(docs)
    for i, w in docs.items():
        assert math.isclose(got[i], sum(score(i, tuple(w[max(0, j - 2) : j + 1])) for j in range(len(w))), abs_tol=2e-3)

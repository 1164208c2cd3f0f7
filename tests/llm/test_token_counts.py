import random

import pytest
from tokenizers import Tokenizer

from fleetmart.llm import queries, token_counts
from fleetmart.llm.encoding import public


def check(found, lengths):
    rows = {r["length"]: r for r in found}
    assert sorted(rows) == sorted(set(lengths)) and len(found) == len(rows)
    for limit, r in rows.items():
        longer = [n for n in lengths if n > limit]
        assert (r["docs"], r["tokens"]) == (lengths.count(limit), limit * lengths.count(limit))
        assert (r["docs_longer"], r["tokens_longer"]) == (len(longer), sum(longer))
        assert r["tokens_truncated"] == sum(min(n, limit) for n in lengths)
        assert r["share"] == pytest.approx(1 - len(longer) / len(lengths))


@pytest.mark.parametrize("block", [1024, 7])
def test_suffix_sums(frame, block):
    rng = random.Random(block)
    lengths = [int(rng.expovariate(0.02)) for _ in range(300)] + [0, 100_000]
    histogram = frame("length long, docs long", *[(n, lengths.count(n)) for n in set(lengths)])
    sums = token_counts.suffix_sums(histogram, block)
    check(sums.collect(), lengths)
    for limit, longer, tokens, cut in token_counts.at_limits(sums, [0, 13, 64, 99_999, 100_000, 10**7]).collect():
        assert (longer, tokens) == (sum(n > limit for n in lengths), sum(n for n in lengths if n > limit))
        assert cut == sum(min(n, limit) for n in lengths)
    lengths.sort()
    for share, length in token_counts.quantiles(sums, [0.0, 0.25, 0.5, 0.9, 1.0]).collect():
        assert length == next(n for k, n in enumerate(lengths, 1) if k >= share * len(lengths) and (k == len(lengths) or lengths[k] > n or k >= share * len(lengths)))


def test_odd_rows(frame):
    docs = frame("doc_id long, text string, length int", (1, None, 5), (1, None, 5), (None, "", 5), (3, "a b " * 5000, 5), (4, " \n\t", 5))
    assert sorted((r["length"], r["docs"]) for r in token_counts.token_counts(docs).collect()) == [(0, 4), (10000, 1)]
    assert token_counts.token_counts(docs.limit(0)).collect() == []


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    plain = Tokenizer.from_file(public())
    texts = [r["text"] for r in queries.table(spark, folder, "documents").collect()]
    check(queries.QUERIES["op3_token_counts"](spark, folder).collect(), [len(plain.encode(t, add_special_tokens=False).ids) for t in texts])

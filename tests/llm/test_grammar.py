"""The grammar of token shards counts every pair and gives all ids back."""

import random
from collections import Counter

import numpy as np

from tabloom.llm import token_store
from tabloom.llm.token_ids import packed

rng = random.Random(8)


def grammar(docs, first_rule, **settings):
    last = np.zeros(sum(map(len, docs)), dtype=bool)
    last[np.cumsum([len(d) for d in docs]) - 1] = True
    return token_store.repair(np.array([i for d in docs for i in d], np.uint32), last, first_rule, **settings)


def test_no_frequent_pair_is_left_out():
    """Documents of two ids: the rules are the pairs seen often enough, however many share a place of the table."""
    seen = Counter((rng.randrange(900), rng.randrange(900)) for _ in range(60_000))
    docs = [list(p) for p, n in seen.items() for _ in range(n * rng.choice([1, 1, 9]))]
    counts = Counter(map(tuple, docs))
    rng.shuffle(docs)
    symbols, last, rounds = grammar(docs, 900, least_gain=0)
    rules = [tuple(r) for a, b in rounds for r in zip(a.tolist(), b.tolist())]
    assert sorted(rules) == sorted(p for p, n in counts.items() if n >= token_store.LEAST_COUNT)
    assert last.sum() == len(docs)
    assert len(symbols) == sum(1 if counts[tuple(d)] >= token_store.LEAST_COUNT else 2 for d in docs)


def test_rules_expand_to_the_ids():
    for _ in range(20):
        letters = rng.choice([1, 2, 30])
        docs = [[rng.randrange(letters) for _ in range(rng.choice([1, 3, 400]))] for _ in range(rng.randint(1, 30))]
        for gain in (0, 0.01, 1):
            symbols, last, rounds = grammar(docs, letters, least_gain=gain)
            whole = {i: [i] for i in range(letters)}
            for a, b in rounds:
                whole |= {len(whole) + i: whole[x] + whole[y] for i, (x, y) in enumerate(zip(a.tolist(), b.tolist()))}
            out, doc = [], []
            for s, end in zip(symbols.tolist(), last.tolist()):
                doc += whole[s]
                if end:
                    out.append(doc)
                    doc = []
            assert out == docs


def test_repeated_text_becomes_few_symbols():
    docs = [list(range(64)) for _ in range(200)]
    file = token_store.shard_file([packed(d) for d in docs], 64)
    assert len(file) < 4 * 64 * 200 / 4
    assert token_store.ShardReader(file).document(150, 10, 20) == list(range(10, 20))

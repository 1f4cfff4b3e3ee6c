"""Span removal gives one result, whatever the number of blocks of the benchmark."""

import random

from tidemart.llm import decontaminate


def test_spans_do_not_depend_on_the_number_of_blocks(spark):
    rng = random.Random(6)
    prose = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    passages = [prose(n) for n in (10, 14, 30, 60, 4)]
    rows = [(i, " ".join([*prose(12), *rng.choice(passages), *prose(7), *rng.choice(passages), *prose(3)]) + "!", "x", [i])
            for i in range(25)]
    rows += [(50, None, "x", None), (51, "", "x", None), (51, "é, " + " ".join(passages[2]).upper() + " ü", "x", None),
             (None, " ".join(passages[3]), "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, _hits array<long>").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(passages)], "item_id long, text string")
    order = lambda x: sorted(map(repr, x.collect()))
    one = decontaminate.remove(docs, bench, spans=True)
    want = order(one)
    assert not any(" ".join(passages[2]) in x for x in want)
    for most in (40, 4):
        cut = decontaminate.remove(docs, bench, spans=True, max_windows=most)
        assert cut.columns == docs.columns and order(cut) == want

"""A benchmark of several blocks is held one block at a time."""

from tidemart.llm import decontaminate


def test_a_block_is_gone_before_the_next_is_built(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "nothing of it"), (3, " ".join(words[20:40]))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    seen, build, share = [], decontaminate._block, decontaminate._share

    def built(table):
        seen.append("built")
        return build(table)

    def shared(session, block):
        out = share(session, block)
        destroy = out.destroy
        out.destroy = lambda *a: (seen.append("destroyed"), destroy(*a))
        return out
    monkeypatch.setattr(decontaminate, "_block", built)
    monkeypatch.setattr(decontaminate, "_share", shared)
    flags = {r.doc_id: r.n_hit for r in decontaminate.flag(docs, bench, max_windows=10).collect()}
    assert flags == {1: 60, 2: 0, 3: 20}
    assert [r.doc_id for r in decontaminate.remove(docs, bench, max_windows=10).collect()] == [2]
    texts = {r.doc_id: r.text for r in decontaminate.remove(docs, bench, spans=True, max_windows=10).collect()}
    assert texts == {1: "", 2: "nothing of it", 3: ""}
    assert len(seen) >= 12 and seen == ["built", "destroyed"] * (len(seen) // 2)

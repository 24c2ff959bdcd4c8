import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tollgauge.llm import decontamination, toxicity
from tollgauge.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of every stage: written and read again."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        out.append((docs, spark.read.parquet(str(folder / name))))
        docs = out[-1][1]
    return out


def test_columns(spark, stages):
    columns = table(spark, SF, "documents").columns
    assert [after.columns == columns for _, after in stages[:-1]] == [True] * 4
    assert stages[-1][1].columns == [*columns, "mix_shard", "mix_copy"]


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_toxic_documents_go(spark, stages):
    before, after = stages[0]
    scored = toxicity.scored(before, table(spark, SF, "labels"))
    assert ids(after) == ids(scored.where(F.col("_toxicity") < toxicity.THRESHOLD))


def test_dropped_documents_share_four_fifths_of_their_shingles(stages):
    before, after = stages[1]
    sets = {}
    for r in before.collect():
        words = (r["text"] or "").lower().split()
        sets[r["doc_id"]] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if b < a and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    moved = True
    while moved:  # all pairs: the least id that links reach
        moved = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                moved = True
    assert ids(after) == sorted(set(label.values()))


def test_repeated_strings_go(stages):
    before, after = stages[2]
    seen, gone = {}, {}
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in before.collect()}
    for d, t in texts.items():
        for i in range(len(t) - 199):
            seen.setdefault(t[i:i + 200], []).append((d, i))
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone.setdefault(d, set()).update(range(i, i + 200))
    for r in after.collect():
        want = bytes(x for i, x in enumerate(texts[r["doc_id"]]) if i not in gone.get(r["doc_id"], ()))
        assert (r["text"] or "") == want.decode("utf-8", "ignore") and r["n_chars"] == len(r["text"])
    assert ids(before) == ids(after)


def test_leaks_go_and_clean_documents_stay(spark, stages):
    before, after = stages[3]
    words = decontamination.Words()
    items = [words.of(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    index = decontamination.Index(list(enumerate(items)))
    leaky = set()
    for r in before.collect():
        text = words.of(r["text"]).tolist()
        if any(index.distance(i, text)[0] <= 0.2 * len(w) for i, w in enumerate(items) if len(w) >= decontamination.LEAST_WORDS):
            leaky.add(r["doc_id"])
    missed = leaky & set(ids(after))
    assert set(ids(after)) >= set(ids(before)) - leaky and len(missed) <= 0.1 * len(leaky)


def test_mix(spark, stages):
    before, after = stages[4]
    size = {r["doc_id"]: (len((r["text"] or "").encode().split()), r["source"]) for r in before.collect()}
    taken = {}
    for r in after.collect():
        assert r["text"] is None or size[r["doc_id"]][1] == r["source"]
        taken[r["source"]] = taken.get(r["source"], 0) + size[r["doc_id"]][0]
    total = sum(n for n, _ in size.values())
    assert abs(sum(taken.values()) - 1.5 * total) < 0.03 * total


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100

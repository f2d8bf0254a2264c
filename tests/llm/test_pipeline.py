"""The pipeline's stages against brute force on their own input."""

from __future__ import annotations

import os
import re

import pytest

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


def shingles(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_stages(spark):
    import corpus_pipeline as cp
    from ripplecast.llm.secrets import secret_report
    from ripplecast.llm.tables import read

    docs = read(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        start = {r["doc_id"]: r["text"] for r in before.collect()}
        if name == "quality_rules":
            bad = {r["doc_id"] for r in read(spark, SF, "labels").where("quality = 0").collect()}
            good = {r["doc_id"] for r in read(spark, SF, "labels").where("quality = 1").collect()}
            enough = {i for i, t in start.items() if len(re.findall(r"[^\x20\x09-\x0D]+", t)) >= 50}
            assert len(bad & kept[name].keys()) <= 0.1 * len(bad)
            assert len(good & enough & kept[name].keys()) >= 0.95 * len(good & enough)
        elif name == "jaccard_join":
            sets = {i: shingles(t) for i, t in start.items()}
            link = {i: {i} for i in sets}
            for a in sets:
                for b in sets:
                    if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        joined = link[a] | link[b]
                        for x in joined:
                            link[x] = joined
            assert kept[name].keys() == {i for i in sets if i == min(link[i])}
        elif name == "decontamination":
            items = [shingles(r["text"]) for r in read(spark, SF, "benchmark").collect()]
            leaks = {i for i, t in start.items() if any(100 * len(q & shingles(t)) >= 80 * len(q) for q in items)}
            assert kept[name].keys() == start.keys() - leaks
        else:
            assert kept[name].keys() == start.keys()
            assert {r["spans"] for r in secret_report(docs).collect()} == {""}
    placed = cp.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in placed} == kept["secret_scan"].keys()
    whole = cp.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, whole)) == sorted(map(key, placed))

"""op5: values of one line do not reach the lists, and shards give the same lists."""

import pytest

line_dedup = pytest.importorskip("menumix.llm.line_dedup")


def test_only_values_of_several_lines_are_listed_and_shards_change_nothing(spark, monkeypatch):
    words = [f"word{i}" for i in range(40)]
    texts = [" ".join(words[i % 5:30 + i % 5]) + f" end{i % 3}\nshort {i % 4} line\nalone {i * 7919} {i * 104729}" for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    listed = []

    def seen(self, index):
        listed.append(sorted(map(tuple, index.select("k", "node").collect())))
        return self.labels.frame  # only the lists are looked at

    monkeypatch.setattr(line_dedup.Search, "run", seen)
    found = [sorted(map(tuple, line_dedup.line_duplicates(docs).collect()))]
    monkeypatch.setattr(line_dedup, "SHARD_BYTES", 4000)
    found.append(sorted(map(tuple, line_dedup.line_duplicates(docs).collect())))
    assert found[0] == found[1] and len(found[0]) == 36 and listed[0] == listed[1]
    counts = {}
    for k, _ in listed[0]:
        counts[k] = counts.get(k, 0) + 1
    assert counts and min(counts.values()) > 1

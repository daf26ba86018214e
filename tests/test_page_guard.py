"""The page guard stream: repeats are caught inside a micro-batch and across a restart."""

import json
import os

from kestrel.streaming import guard as G

PAGES = "dataset string, page bigint, payload string, status string"


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        for dataset, page, payload in rows:
            out.write(json.dumps({"dataset": dataset, "page": page, "payload": payload, "status": "clash"}) + "\n")


def run(spark, tmp_path):
    stream = spark.readStream.schema(PAGES).json(str(tmp_path / "pages"))
    query = G.guard(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert query.awaitTermination(150)
    return sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)


def test_repeats_are_caught_across_a_restart(spark, tmp_path):
    land(tmp_path / "pages", "1.json", [("a", 2, "two"), ("a", 1, "one"), ("b", 1, "one"), (None, 1, None)])
    got = {(d, p): (s, n, f) for d, p, _, s, n, f in run(spark, tmp_path)}
    assert got == {("a", 1): ("success", "", None), ("a", 2): ("success", "", None), ("b", 1): ("success", "", None), (None, 1): ("success", "", None)}
    # a new query from the same checkpoint: only the state store knows the earlier pages
    land(tmp_path / "pages", "2.json", [("a", 3, "two"), ("a", 4, "one"), ("a", 5, "five"), ("b", 2, "one"), ("b", 3, "three"), (None, 2, "")])
    later = {(d, p): (s, n, f) for d, p, _, s, n, f in run(spark, tmp_path) if (d, p) not in got}
    assert later == {("a", 3): ("failed", "repeated_page", 2), ("a", 4): ("skipped", "duplicate_checksum", 1), ("a", 5): ("success", "", None),
                     ("b", 2): ("failed", "repeated_page", 1), ("b", 3): ("success", "", None), (None, 2): ("failed", "repeated_page", 1)}

"""The query that strips one document per program stage, made of parts."""

import hashlib
import random
from datetime import datetime

from conftest import rows

import __spark_entry__ as registered
from tablewinnow.fixtures import BASE_TABLES


def expected(entries):
    found = []
    for stage, own in entries.items():
        kept = sorted(f'"e{event}": {{"at":[{{"unit":{unit}}}]}}' for event, unit in own if unit is not None)
        # With no entry the text ends in a comma and is no object, so it is left as it is.
        document = '\n{"note":"' + "n\\n" * 400_000 + '",}\n'
        if kept:
            kept = [e for e in kept if e.split('"')[1] not in registered.WIDE_KEYS]
            document = "\n{" + ",".join(kept) + "}\n"
        found.append((stage, len(document), hashlib.md5(document.encode()).hexdigest()))
    return sorted(found, key=repr)


def test_parts_make_the_whole_document(spark, tmp_path):
    """Keys of any length, events without a unit or an id, repeated ones and a stage without entries."""
    draw = random.Random(11)
    ids = [0, 1, 2, 4, 2000, 20_000, 2**40, *(draw.randrange(3000) for _ in range(500))]
    events = [(i, datetime(2024, 1, 1), draw.choice([i % 7, None]), "view", 40.0, None) for i in ids]
    events += [events[0], events[-1], (None, None, 5, "view", 40.0, None), (9, None, None, "click", 1.0, None)]
    orders = [(i, draw.randrange(9), "F", 1.0, None, "1-URGENT") for i in (0, 3, 77, 123_456, 123_457)]
    for name, content in (("events", events), ("orders", orders)):
        df = spark.createDataFrame(content, BASE_TABLES[name]).repartition(3)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    entries = {}
    for event_id, _, user, kind, _, _ in events:
        stage = 21 if kind == "view" else 10
        unit = None if event_id is None or user is None else user * 4 + 2
        entries.setdefault(stage, []).append((event_id and event_id * 2, unit))
    entries[110] = [(order * 2 + 1, customer * 4 + 2) for order, customer, *_ in orders]
    found = registered.queries()["strip_wide_documents"](spark, str(tmp_path))
    assert rows(found) == expected(entries)
    # Only parts of a document are gathered by event.
    assert "part" in found._jdf.queryExecution().optimizedPlan().toString()

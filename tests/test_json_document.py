"""Documents in byte ranges against the json module."""

import json
import os
import random
import tempfile

import pytest

from netloom.schemas import D, S, schema
from netloom.sources.collection import Collection, load_json
from netloom.sources.json_document import _pieces, read_tables

MODEL = {"demands": schema(("store", S), ("amount", D)), "emptyOnes": schema(("a", S)), "routes": schema(("location", S), ("cost", D)), "absent": schema(("x", D))}


def _document(odd):
    rnd = random.Random(odd)
    strange = ['a "quoted" one', "back\\slash", 'ends in \\"', "é 日本", "line\nbreak", "]", "[,", '"demands": [', "", None]
    strange += ["a } brace", "{}", '"}', "}" * 3, '\\}"', '}, {"store": "no", "amount": 1'] if odd else ["{ open"]
    return {
        "title": "no \\ table", "version": 1.5,
        "demands": [{"store": rnd.choice(strange) if i % 3 == 0 else f"s{i}", "amount": i} for i in range(400)],
        "emptyOnes": [], "note": None,
        "routes": [{"location": rnd.choice(strange), "cost": i / 4, "more": "not declared"} for i in range(300)],
    }


@pytest.mark.parametrize("odd", [0, 1, 2])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_equal_the_json_module(spark, odd, indent):
    doc = _document(odd)
    path = os.path.join(tempfile.mkdtemp(prefix="netloom-json-"), "doc.json")
    with open(path, "w") as f:
        json.dump(doc, f, indent=indent, ensure_ascii=bool(odd == 2))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert _pieces(spark, path).rdd.getNumPartitions() > 4
        got = {t: sorted(map(repr, map(tuple, df.collect()))) for t, df in read_tables(spark, path, MODEL).items()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    want = {t: sorted(repr(tuple(float(r[c]) if c in ("amount", "cost") else r[c] for c in s.fieldNames())) for r in doc.get(t, [])) for t, s in MODEL.items()}
    assert got == want


@pytest.mark.parametrize("text", ["", '{"demands": [{"store": "a", "amount": 1}', '{"demands": [{"store": "a", "amount": 1', '[{"store": "a"}]'])
def test_a_broken_document_is_an_error(spark, text):
    path = os.path.join(tempfile.mkdtemp(prefix="netloom-json-"), "doc.json")
    with open(path, "w") as f:
        f.write(text)
    with pytest.raises(ValueError):
        read_tables(spark, path, MODEL)


def test_a_document_in_parts(spark):
    doc = _document(1)
    tables = Collection("c")
    for t in ("demands", "emptyOnes", "routes"):
        names = MODEL[t].fieldNames()
        tables = tables.add_rows(spark, t, [tuple(float(r[c]) if c in ("amount", "cost") else r[c] for c in names) for r in doc[t]], MODEL[t])
    path = os.path.join(tempfile.mkdtemp(prefix="netloom-json-"), "doc")
    tables.write_document(path)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    assert len(parts) > 1
    whole = "".join(open(os.path.join(path, p)).read() for p in parts)
    assert {t: len(v) for t, v in json.loads(whole).items()} == {"demands": 400, "emptyOnes": 0, "routes": 300}
    back = load_json(spark, path, {t: MODEL[t] for t in ("demands", "emptyOnes", "routes")}, snake_case=False)
    for t in tables.names():
        assert back[t].exceptAll(tables[t]).count() == 0 and back[t].count() == tables[t].count()

"""License scans: base places against a plain search, templates on notices whole, edited, scattered and beside others."""

import random
import re

import pytest

from lumenvox.llm.license_scan import BASE, TEMPLATES, license_digests

SCHEMA = "doc_id long, text string, words string, base string, found string, _row long"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base_of(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = sorted((i, label) for phrase, label in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def check_base(found, texts):
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def scan(spark, texts, **options):
    docs = spark.createDataFrame([(k, t, "w", "b", "f", 1) for k, t in texts.items()], SCHEMA)
    found = license_digests(docs.repartition(3), **options).collect()
    assert len(found) == len(texts)
    check_base(found, texts)
    return {r.doc_id: r for r in found}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = license_digests(docs).collect()
    assert len(found) == len(texts)
    check_base(found, texts)
    for r in found:
        if "Licensed under CC BY-NC 4.0" in (texts[r.doc_id] or ""):
            assert "cc-by-nc" in r.labels.split(",")
        if "icens" not in (texts[r.doc_id] or ""):
            assert r.labels == ""


def test_base_places(spark):
    rng = random.Random(2)
    some = "mit license apache general public gnu LICENSE MIT, the license-mit mitlicense Ä1 0 é \U0001f600 \x00".split(" ")
    texts = {i: " ".join(rng.choice(some) for _ in range(rng.randrange(0, 60))) for i in range(300)}
    texts |= {900: None, 901: "", 902: " .,\n", 903: "mit license " * 50_000, 904: "MIT\nLicense", 905: "general public public license general public license", 906: "İmit license", 907: "mit license"}
    scan(spark, texts)


def test_templates(spark):
    filler = "Some words of a text about rivers and stones that goes on for a while. " * 40
    texts = {}
    for k, t in enumerate(TEMPLATES):
        texts[k] = filler + t.text + ". " + filler
        words = t.text.split()
        texts[100 + k] = filler + " ".join([*words[: len(words) // 2], "(c)", *words[len(words) // 2 :]]) + filler if len(words) > 12 else t.text
        texts[200 + k] = filler + f" {filler} ".join(w for w in words) + filler  # all words, far from each other
        texts[300 + k] = "\n".join(["x " * 5_000, t.text, "y " * 5_000, t.text.upper()])
    found = scan(spark, texts)
    for k, t in enumerate(TEMPLATES):
        for kind in (0, 300):
            assert t.label in found[kind + k].labels.split(",") and found[kind + k].score == pytest.approx(1.0)
        if not any(key in " ".join(WORD.findall(texts[100 + k].lower())) for key in t.keys):
            continue
        assert t.label in found[100 + k].labels.split(",") or len(t.keys) > 1
        assert found[200 + k].labels == "" and found[200 + k].score == 0


def test_keys_are_mandatory(spark):
    mit = next(t for t in TEMPLATES if t.label == "mit")
    without = mit.text.replace("free of charge", "for money")
    key_alone = "We say that permission is hereby granted, free of charge. " + "x " * 500 + "to deal in the software without restriction"
    found = scan(spark, {1: mit.text, 2: without, 3: key_alone, 4: "to be licensed under cc by nobody"})
    assert [found[k].labels for k in (1, 2, 3)] == ["mit", "", ""]


def test_few_and_no_rows(spark):
    assert license_digests(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(None, "MIT License", "", "", "", 1), (1, "MIT License", "", "", "", 1), (1, "MIT License", "", "", "", 1)], SCHEMA)
    assert [tuple(r) for r in license_digests(docs).orderBy("doc_id").collect()] == [(i, 2, 1, 0, 0, "mit", "mit", 1.0) for i in (None, 1, 1)]
    assert [r.labels for r in license_digests(docs, templates=()).collect()] == ["mit"] * 3

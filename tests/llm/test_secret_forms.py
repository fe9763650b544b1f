"""Common forms of secrets that the entropy classes must find."""

from __future__ import annotations

from lumenvox.llm.secret_scan import secret_digests

FORMS = [
    ("ENC_KEY=", "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B", "entropy_hex"),
    ("key/", "9F86D081884C7D659A2FEAA0C55AD015A3BF4F1B", "entropy_hex"),
    ("sample_key=", "q7Zt1vXc9Lm3Pw8RbK5yHd2NfJ6sGa4T", "entropy_base64"),
    ("id=", "q7zt1vxc9lm3pw8rbk5yhd2nfj6sga4t", "entropy_lower"),
    ("id: ", "Q7ZT1VXC9LM3PW8RBK5YHD2NFJ6SGA4T", "entropy_upper"),
    ("v=", "q7Zt1vXc9Lm3exampleRbK5yHd2NfJ6sGa4T", "entropy_base64"),
]


def test_values_are_found_after_names_and_in_every_mixture(spark):
    docs = [(i, name + value) for i, (name, value, _) in enumerate(FORMS)]
    docs += [(100, "id=123e4567-e89b-12d3-a456-426614174000"), (101, "key=your_example_token_placeholder_12")]
    found = {r.doc_id: r.spans for r in secret_digests(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, (name, value, kind) in enumerate(FORMS):
        assert f"{kind}:{len(name)}:{len(name) + len(value)}" in found[i].split(","), (FORMS[i], found[i])
    assert not any("entropy" in found[i] for i in (100, 101))

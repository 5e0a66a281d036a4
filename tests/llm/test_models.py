import os

import numpy as np
import pytest

from weftline.llm import encode, mixing, pii
from weftline.llm.pii_labels import labelled_table

TEXTS = ["Hello world's end, don't!", "", None, "<|endoftext|> is text", "杉畝野市では漫画原画展示が広がった。ットット", "a" * 3000, " \n\n \t x  ", "éß 😀👩‍👩‍👧 ZZ", "==" * 700, "한국어 문장 12345"]
needs_vocabulary = pytest.mark.skipif(not os.path.exists(encode.VOCABULARY), reason="no vocabulary file")


@needs_vocabulary
def test_ids_equal_the_public_tokenizer():
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(encode.VOCABULARY)
    reference.encode_special_tokens = True
    want = [x.ids for x in reference.encode_batch([t or "" for t in TEXTS], add_special_tokens=False)]
    assert encode.Encoder().encode(TEXTS) == want


@needs_vocabulary
def test_ids_of_a_table(spark):
    table = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in encode.token_ids(table).collect()}
    merges = encode.Merges()
    assert len(got) == len(TEXTS) and got[1] == got[2] == []
    assert all(merges.decode(got[i]) == (t or "") for i, t in enumerate(TEXTS))
    assert encode.token_ids(table.limit(0)).count() == 0
    assert {r.doc_id: r.tokens for r in encode.token_counts(table, ["doc_id"]).collect()} == {i: len(x) for i, x in got.items()}


def test_raking_meets_marginals_under_caps():
    tokens = np.array([10.0, 30, 20, 40])
    rows, columns = np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])
    weight = mixing.rake(tokens, [(columns, np.array([45.0, 55])), (rows, np.array([60.0, 40]))], np.full(4, np.inf))
    assert np.allclose(np.bincount(rows, weight * tokens), [60, 40]) and np.allclose(np.bincount(columns, weight * tokens), [45, 55])
    capped = mixing.rake(tokens, [(rows, np.array([78.0, 30]))], np.array([2.0, 2, 2, 2]))
    assert np.allclose(np.bincount(rows, capped * tokens), [78, 30])
    with pytest.raises(ValueError):
        mixing.rake(tokens, [(rows, np.array([100.0, 30]))], np.array([2.0, 2, 2, 2]))


def test_raking_under_active_caps():
    """Marginals of random weights under the caps can be met, and are; the weights are the nearest in relative entropy."""
    rng = np.random.default_rng(4)
    for _ in range(60):
        n_rows, n_columns = int(rng.integers(2, 6)), int(rng.integers(2, 6))
        rows, columns = np.divmod(np.arange(n_rows * n_columns), n_columns)
        tokens = rng.integers(0, 90, n_rows * n_columns).astype(float)
        cap = rng.choice([0.5, 1, 1.5, 4], n_rows)[rows]
        some = np.minimum(rng.random(len(tokens)) * 3, cap)  # many stand at their caps
        margins = [(columns, np.bincount(columns, some * tokens)), (rows, np.bincount(rows, some * tokens))]
        weight = mixing.rake(tokens, margins, cap, rounds=20_000)
        assert (weight <= cap + 1e-9).all()
        for of, target in margins:
            assert np.allclose(np.bincount(of, weight * tokens), target, atol=1e-5 * max(1, tokens.sum()))


def test_cells_keep_their_languages_under_caps():
    import pandas as pd

    cells = pd.DataFrame([("a", "ja", 100, 1), ("a", "en", 50, 1), ("b", "ja", 30, 1), ("b", "en", 70, 1), ("c", "ja", 10, 1), ("c", "en", 40, 1)], columns=["source", "lang", "tokens", "docs"])
    for caps, want in (((1, 4, 0.5), (0.4, 1.5, 0.5)), ((1, 2, 1), (0.4, 1.5, 1.0)), ((9, 9, 9), (0.4, 1.5, 1.8)), ((None, 1, 1), (0.4, 1.0, 1.0))):
        targets = pd.DataFrame({"source": list("abc"), "target_share": [0.2, 0.5, 0.3], "max_repeats": caps})
        got = mixing.cell_weights(cells, targets)
        assert np.allclose(got["weight"], np.repeat(want, 2)), caps
    targets = pd.DataFrame({"source": list("abc"), "target_share": [0.2, 0.5, 0.3], "max_repeats": [1, 4, 0.5]})
    got = mixing.cell_weights(cells, targets, {"ja": 0.5})
    of_lang = (got["weight"] * got["tokens"]).groupby(got["lang"]).sum()
    assert abs(of_lang["ja"] / of_lang.sum() - 0.5) < 1e-6 and np.allclose((got["weight"] * got["tokens"]).groupby(got["source"]).sum(), [60, 150, 25], atol=1e-3)
    with pytest.raises(ValueError):
        mixing.cell_weights(cells, targets, {"ja": 0.99})


def test_raking_gives_the_weights(monkeypatch):
    """What goes into the fit isn't its result yet, and each marginal moves the weights."""
    import pandas as pd

    cells = pd.DataFrame([("a", "ja", 100, 1), ("a", "en", 50, 1), ("b", "ja", 30, 1), ("b", "en", 70, 1), ("c", "ja", 0, 1)], columns=["source", "lang", "tokens", "docs"])
    targets = pd.DataFrame({"source": list("abc"), "target_share": [0.2, 0.5, 0.3], "max_repeats": [1, None, 1]})
    calls = []
    rake = mixing.rake
    monkeypatch.setattr(mixing, "rake", lambda *a: calls.append(a) or rake(*a))
    for of_lang in (None, {"ja": 0.5}):
        got = mixing.cell_weights(cells, targets, of_lang)["weight"].to_numpy()
        tokens, margins, cap, *start = calls.pop()
        full = tokens > 0
        assert not np.allclose(got[full], np.minimum(start[0] if start else np.ones(len(tokens)), cap)[full])
        for i in range(len(margins)):
            assert not np.allclose(rake(tokens, margins[:i] + margins[i + 1 :], cap, *start)[full], got[full])


def test_draws(spark):
    import random

    rng = random.Random(1)
    rows = [(i, "abc"[i % 3], rng.choice(["ja", "en", None, "??"]), rng.randrange(0, 60)) for i in range(3000)] + [(9999, "a", "ja", 900)]
    sized = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, tokens bigint").withColumn("lang", mixing.language(mixing.F.col("lang")))
    targets = spark.createDataFrame([("a", 0.2, 1.0), ("b", 0.5, 4.0), ("c", 0.3, 0.5), ("none", 0.0, None)], "source string, target_share double, max_repeats double")
    drawn = mixing.draws(sized, targets)
    shares = mixing.mix_shares(sized, drawn, targets).collect()
    share = {r.name: r for r in shares if r.dimension == "source"}
    of_lang = {r.name: r.drawn_tokens for r in shares if r.dimension == "language"}
    assert sum(of_lang.values()) == sum(r.drawn_tokens for r in share.values()) and set(of_lang) == {"ja", "en", "und"}
    assert abs(share["a"].actual_share - 0.2) < 0.01 and abs(share["b"].actual_share - 0.5) < 0.01
    assert abs(share["c"].actual_share - 0.5 * share["c"].own_tokens / sum(s.own_tokens for s in share.values())) < 0.01  # capped, stays below
    assert share["none"].drawn_tokens == 0 and max(r.copies for r in drawn.where("source = 'a'").collect()) == 1
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, mixing.draws(sized, targets).collect()))
    assert mixing.draws(sized.limit(0), targets).count() == 0 and mixing.draws(sized, targets.limit(0)).count() == 0


@pytest.fixture(scope="module")
def field():
    return pii.trained()


def test_held_out_accuracy(field):
    held = labelled_table(2, 1234)
    got = pii.mentions([t for t, _ in held], field, pii.Names([]))
    want = {(i, k, a) for i, (_, spans) in enumerate(held) for a, _, k in spans}
    found = {(i, k, a) for i, rows in enumerate(got) for k, a, _ in rows}
    hit = len(want & found)
    assert hit / len(want) > 0.96 and hit / len(found) > 0.96


def test_mentions_and_redaction(field):
    text = "委員に霧渡 朔也、琴筏の両氏が就いた。\r\nCall (212) 555-0115 and ask for Ms Odrin Zerrockel.\n図録のISBNは978-0-55-00009-0。 Contact: a.b [at] post [dot] test / 555-0133"
    (rows,) = pii.mentions([text], field, pii.Names([("霧渡", "family"), ("Odrin", "given")]))
    kinds = [(k, text[a:b]) for k, a, b in rows]
    assert ("person", "霧渡 朔也") in kinds and ("phone", "(212) 555-0115") in kinds and ("person", "Odrin Zerrockel") in kinds
    assert any(k == "email" and v.startswith("a.b") for k, v in kinds) and not any("978" in v for _, v in kinds)
    clean = pii.redact(text, rows)
    assert "[PHONE]" in clean and "霧渡" not in clean and "ISBN" in clean and pii.redact(None, []) is None


def test_tables(spark, field):
    names = spark.createDataFrame([(1, "霧渡", "family", "ja"), (2, None, None, None)], "name_id int, name_text string, name_kind string, script string")
    docs = spark.createDataFrame([(1, "E-mail x@post.test", "k"), (2, None, "k"), (3, "", "k"), (4, "E-mail x@post.test", "k"), (5, "語 " * 60_000, "k")], "doc_id bigint, text string, kind string")
    got = sorted(map(tuple, pii.personal_mentions(docs, names).select("doc_id", "kind", "start_pos").collect()))
    assert [r for r in got if r[0] != 5] == [(1, "email", 7), (4, "email", 7)]
    clean = {r.doc_id: r.text for r in pii.redacted_documents(docs, names).collect()}
    assert clean[1] == "E-mail [EMAIL]" and clean[2] is None and clean[3] == ""
    assert pii.personal_mentions(docs.limit(0), names.limit(0)).count() == 0


def test_marginals_of_gradient_training():
    from weftline.llm.pii import Names, train

    small = train([("call Bob now", [(5, 8, "person")]), ("call it now", [])] * 20, Names([]), epochs=5)
    assert [[(k, a) for k, a, _ in r] for r in pii.mentions(["call Bob now", "call it now"], small, Names([]))] == [[("person", 5)], []]


def test_no_row_is_lost_over_many_batches(spark, field):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = spark.range(1, 1201).selectExpr("id as doc_id", "concat('Call 555-01', lpad(id % 100, 2, '0'), ' and ask for Ms Zerrockel.') as text").coalesce(1)
        names = spark.createDataFrame([], "name_id int, name_text string, name_kind string, script string")
        assert pii.redacted_documents(docs, names).select("doc_id").distinct().count() == 1200
        assert pii.personal_mentions(docs, names).where("kind = 'phone'").select("doc_id").distinct().count() == 1200
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_other_sentences_and_names(field):
    """Forms and names that no carrier has: all e-mail addresses and phone numbers, and most names as a whole."""
    from held_out_mentions import parsed  # beside this file, which pytest puts on the path

    rows = parsed()
    got = pii.mentions([t for t, _ in rows], field, pii.Names([]))
    want = {(i, *s) for i, (_, spans) in enumerate(rows) for s in spans}
    found = {(i, *g) for i, r in enumerate(got) for g in r}
    persons = {x for x in want if x[1] == "person"}
    assert want - persons <= found
    assert len(persons & found) >= 0.55 * len(persons) and len(persons & found) >= 0.7 * sum(x[1] == "person" for x in found)


def test_long_sequences_are_decoded_whole(field):
    """No cut inside a line without marks: a mention deep in it comes out as it does alone."""
    filler = "library archive mural textile " * 700
    text = f"{filler}and call +44 20 7946 0123 for the {filler}"
    (alone,), (rows,) = pii.mentions(["and call +44 20 7946 0123 for the library"], field, pii.Names([])), pii.mentions([text], field, pii.Names([]))
    assert [(k, a + len(filler), b + len(filler)) for k, a, b in alone if k == "phone"] == [r for r in rows if r[0] == "phone"] != []

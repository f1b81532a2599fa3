"""The ledger against counts of the state that the changes leave."""

import random

import pytest

from tidelog.llm.token_rollup import WORDS, TokenLedger, corpus_changes
from tidelog.session import scratch

SCHEMA = "seq long, op string, doc_id long, source string, lang string, text string, n_docs string"


def state_totals(state):
    totals = {}
    for source, lang, text in state.values():
        n, t = totals.get((source, lang), (0, 0))
        totals[source, lang] = (n + 1, t + len((text or "").split()))
    return totals


def totals(ledger):
    return {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}


def test_batches_repeats_and_retries(spark):
    rng, state = random.Random(1), {}
    ledger = TokenLedger(spark, scratch(spark, "ledger"), [WORDS])
    assert ledger.totals().count() == 0
    for batch in range(4):
        rows = []
        for seq in range(60):
            doc = rng.randrange(25)
            op = rng.choice(["insert", "insert", "delete", "revise", "noise"])
            text = rng.choice([None, "", "a b c " * rng.randrange(5)])
            rows.append((seq, op, doc, rng.choice(["s", "t", None]), rng.choice(["en", None]), text, None))
        rows.append((99, "insert", None, "s", "en", "lost", None))
        last = {r[2]: r for r in rows if r[2] is not None and r[1] != "noise"}
        for doc, r in last.items():
            state.pop(doc, None)
            if r[1] != "delete":
                state[doc] = (r[3], r[4], r[5])
        changes = spark.createDataFrame(rows, SCHEMA)
        ledger.deltas(changes).write.parquet(f"{ledger.root}/batches/{batch}-unfinished")  # a try that was lost
        assert ledger.apply(changes, batch)
        assert not ledger.apply(changes, batch)
        assert not TokenLedger(spark, ledger.root, [WORDS])._commit(batch, "late")
        assert totals(ledger) == state_totals(state)
    assert ledger.apply(spark.createDataFrame([], SCHEMA), 9) and totals(ledger) == state_totals(state)


def test_a_mark_that_was_not_written_out(spark):
    ledger = TokenLedger(spark, scratch(spark, "ledger"), [WORDS])
    changes = spark.createDataFrame([(1, "insert", 1, "s", "en", "a b", None)], SCHEMA)
    fs, path = ledger._path("commits/0")
    fs.create(path, False).close()  # a driver that was lost between the two steps
    assert totals(ledger) == {}
    assert ledger.apply(changes, 0) and not ledger.apply(changes, 0)
    assert totals(ledger) == {("s", "en"): (1, 2)}


def test_versions_and_corpus(spark):
    rows = [(1, "mail me@x.org now", "s", "en"), (2, "same text", "s", "en"), (3, "same text", "t", "de"), (4, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    ledger = TokenLedger(spark, scratch(spark, "ledger"), ["byte_bpe_50k", WORDS])
    assert [ledger.apply(c, b) for b, c in corpus_changes(docs)] == [True, True, True, False]
    got = {(r["source"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}
    assert got["s", WORDS] == (2, 5) and got[None, WORDS] == (1, 0) and ("t", WORDS) not in got
    from tidelog.llm.tokens import ByteBpe

    bpe = ByteBpe()
    assert got["s", "byte_bpe_50k"][1] == sum(len(bpe.encode(t)) // 4 for t in ("mail <mail> now", "same text"))


@pytest.mark.parametrize("text", ["x@y.zz", "no mail"])
def test_only_rows_with_mail_are_revised(spark, text):
    docs = spark.createDataFrame([(1, text, "s", "en")], "doc_id long, text string, source string, lang string")
    assert corpus_changes(docs)[2][1].count() == ("@" in text)

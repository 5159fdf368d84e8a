import re
from collections import Counter

import pytest

from quarry.llm import host_rules as H
from tests.llm.fixtures import ODD, SCHEMA, frame, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit))


@pytest.mark.parametrize("text", [
    "", "a b", "a b c a b c", "x x x x", "l\nl\n\n \nl", "#1 $2 <b> z　q", prose(1, 400)])
def test_counts_match_brute_force(text):
    n_words, chars, symbols, _, dup, repeat = H.count_text(text)
    assert (n_words, chars, symbols, dup, repeat) == brute(text)


def test_odd_rows_and_clashing_columns(spark):
    out = H.op10_host_rules(frame(spark, clash=("kept", "salt", "failed", "n_words"))).collect()
    assert len(out) == len(ODD)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words) for r in out)
    assert got == Counter((i, *brute(t)) for i, t, _ in ODD)
    assert all(r.kept is False for r in out if r.n_words < 50)


def test_host_verdict_rejects_only_bad_hosts(spark):
    good = [(i, prose(i, 80), "good") for i in range(30)]
    bad = [(100 + i, "no " * 60 if i else prose(7, 80), "bad") for i in range(30)]
    lone = [(200, "too short", "lone"), (201, prose(3, 80), None)]
    out = {r.doc_id: r for r in H.op10_host_rules(frame(spark, good + bad + lone)).collect()}
    assert all(out[i].kept for i in range(30)) and out[201].kept
    assert not out[100].base_failed and not out[100].kept  # its host's verdict
    assert out[200].base_failed


def test_shrinkage_and_empty_table(spark):
    rules = H.with_rules(H.document_counts(frame(
        spark, [(i, prose(i, 80) if i % 2 else "x", f"h{i % 3}") for i in range(12)])))
    for r in H.host_verdicts(rules).collect():
        assert 0 < r.host_rate < 1
    assert H.op10_host_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_hot_hosts_are_dealt_over_keys(spark):
    hosts = spark.createDataFrame([("hot", 4000), ("warm", 9), *((f"h{i}", 1) for i in range(5991))],
                                  "source string, host_docs long")  # 10,000 documents
    assert [tuple(r) for r in H.hot_hosts(hosts).collect()] == [("hot", 400)]
    assert H.hot_hosts(hosts.limit(0)).count() == 0


def test_hot_host_keeps_its_rows_and_verdict(spark):
    rows = [(i, "no " * 60, "hot") for i in range(400)] + [
        (1000 + i, prose(i, 80), f"h{i % 50}" if i % 3 else None) for i in range(300)]
    out = H.op10_host_rules(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _, _ in rows)
    assert all(r.kept == (r.doc_id >= 1000) for r in out)

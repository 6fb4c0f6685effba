"""Tombstones that depend on earlier tombstones, against findings applied one by one."""

import random

import pytest

from palimpsest.operators import secrets

RECORDS = "rel_path string, line_no bigint, raw string"
FINDINGS = "finding_no bigint, rel_path string, line_no bigint, rule string, secret string"


def one_by_one(records, findings):
    """(no, replacements, tombstoned) by the definition; a tombstone holds no secret."""
    texts = {(p, n): raw for p, n, raw in records}
    out = []
    for no, path, line, _, secret in sorted(findings):
        n = 0
        for key, raw in texts.items():
            if key[0] == path and raw is not None and secret in raw:
                n += raw.count(secret)
                texts[key] = raw.replace(secret, "-")
        fell = n == 0 and (path, line) in texts
        if fell:
            texts[path, line] = None
        out.append((no, n, fell))
    return out


def outcomes(spark, records, findings):
    got = secrets.apply_secret_findings(spark.createDataFrame(records, RECORDS), spark.createDataFrame(findings, FINDINGS))[1]
    return sorted((r["finding_no"], r["replacements"], r["tombstoned"]) for r in got.collect())


@pytest.mark.parametrize("limit", [secrets.FOLD_HITS, 0])
def test_random_dependencies(spark, monkeypatch, limit):
    monkeypatch.setattr(secrets, "FOLD_HITS", limit)
    draw = random.Random(11)
    records, findings = [], []
    for file in range(4):
        path = f"f{file}.jsonl"
        words = [f"secret{file}x{i:02d}y" for i in range(14)]
        records += [(path, n, " ".join(draw.sample(words, draw.randint(0, 2)))) for n in range(1, 9)]
        findings += [(path, draw.randint(1, 9), "r", w) for w in words]
    draw.shuffle(findings)
    findings = [(no, *f) for no, f in enumerate(findings, 1)]
    want = one_by_one(records, findings)
    assert any(fell for _, _, fell in want)
    assert outcomes(spark, records, findings) == want


def test_long_chain_takes_a_fixed_number_of_jobs(spark):
    def run(n):
        # Each secret stands only in the record that the finding before it turns into a tombstone.
        records = [("a.jsonl", i, f"key{i + 1:05d}z") for i in range(1, n + 1)]
        findings = [(i, "a.jsonl", i, "r", f"key{i:05d}z") for i in range(1, n + 1)]
        group = f"chain-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert outcomes(spark, records, findings) == [(i, 0, True) for i in range(1, n + 1)]
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setJobGroup("rest", "rest")
    assert run(1000) <= run(10) + 8

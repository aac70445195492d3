"""Wider tokens of any length."""

from __future__ import annotations

import random
import string

from cases import frame

from trailspark.llm.secret_scan import candidates, secret_report

ALPHABET = string.ascii_letters + string.digits


def token(n, seed):
    rng = random.Random(seed)
    return "aB3" + "".join(rng.choice(ALPHABET) for _ in range(n - 3))


def test_tokens_of_any_length_are_candidates(spark):
    for n in (31, 32, 512, 513, 5_000, 200_000):
        found = candidates(f"see {token(n, n)} here")
        assert [(s, k, e) for s, k, e, _ in found] == ([(4, 3, 4 + n)] if n >= 32 else []), n
    rows = [(n, f"see {token(n, n)} here", "en", "s", 0) for n in (512, 513, 5_000)]
    got = {r["doc_id"]: r for r in secret_report(frame(spark, rows)).collect()}
    for n in (512, 513, 5_000):
        assert got[n]["spans"] == f"token:4:{4 + n}" and got[n]["n_live"] == 1

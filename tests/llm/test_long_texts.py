"""Scans on texts that repeat one pattern very often, in a session of their own, and against ``re`` on a whole table."""

import os
import re
import subprocess
import sys
import textwrap

import pytest

from brakelight.llm import pii, secrets
from brakelight.llm.common import table

DIR = "/root/testdata/sf0.01"
CODE = """
import random, sys, time
sys.path.insert(0, {root!r})
from brakelight.session import get_session
from brakelight.llm import pii, secrets
spark = get_session(master="local[2]", shuffle_partitions=2)
rng = random.Random(3)
n = 100_000
texts = ["x@" + "a." * n + "com", "joe (at) " + "b." * n + "com", "12-" * n + "a", "4 " * n, "+1" + " 2" * n,
         "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1 << 20)),
         "mail me at joe@example.org now " * 20_000, "deadbeef" * 4 + " " + "token=abcdef12 " * 20_000, "1.2.3.4 " * 20_000,
         "example9fQ2zXw7LmP4vT8sYb1KdR6h" * 3_000]
df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
began = time.time()
a = {{r.doc_id: r for r in secrets.scan_secrets(df).collect()}}
b = {{r.doc_id: r for r in pii.find_pii(df).collect()}}
assert time.time() - began < 240, time.time() - began
assert b[0].n_email == 1 and (b[0].base[0].s, b[0].base[0].e) == (0, len(texts[0]))
assert b[6].n_email == 20_000 and b[8].n_ip == 20_000
assert (b[6].base[-1].s, b[6].base[-1].e) == (31 * 19_999 + 11, 31 * 19_999 + 26)
assert a[7].n_assign == 20_000 and a[7].n_hex == 1
assert [(x.s, x.k, x.e) for x in a[5].spans if x.k == 3], "a random run is a span"
print("done", round(time.time() - began))
"""


def test_no_text_ends_the_session():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    got = subprocess.run([sys.executable, "-c", textwrap.dedent(CODE.format(root=root))], capture_output=True, text=True, timeout=600)
    assert got.returncode == 0 and "done" in got.stdout, (got.stdout + got.stderr)[-2000:]


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def base_pii(t):
    found = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
              if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    return found + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                    if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def base_secrets(t):
    a = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    return ([(m.start(), 0, m.end()) for m in a.finditer(t) if len(m[1]) >= 6]
            + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
            + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
def test_base_spans_match_re_on_a_whole_table(spark):
    docs = table(spark, DIR, "documents")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in pii.find_pii(docs).collect():
        assert [(x.k, x.s, x.e) for x in r.base] == sorted(base_pii(text[r.doc_id]))
    for r in secrets.scan_secrets(docs).collect():
        assert [(x.s, x.k, x.e) for x in r.base] == sorted(base_secrets(text[r.doc_id]))

import hashlib
import math
import random
import re
import time
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import AWKWARD
from pyspark.sql import functions as F

from shopgrain.llm import secrets

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


PARTS = ["password", "Token", "API_KEY", "=", ": ", '"', " ", "abcdefghijkl", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "😀", "é", "\n", "xy"]


def test_base_spans_against_regular_expressions(spark):
    texts = []

    @settings(max_examples=150, database=None, derandomize=True)
    @given(st.lists(st.sampled_from(PARTS), max_size=14))
    def collect(parts):
        texts.append("".join(parts))

    collect()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secrets.scan_secrets(docs).collect():
        want = brute(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), texts[row["doc_id"]]
        assert ",".join(x for x in row["spans"].split(",") if not x.startswith("entropy")) == want


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


def test_entropy_of_sliding_windows(spark):
    value = "z" * 22 + "Zk9Qw3Xv7Bn1Mj5Hg2Ld8" + "z1" * 12
    hot = [i for i in range(len(value) - 19) if entropy(value[i : i + 20]) >= 3.8]
    docs = spark.createDataFrame([(1, f"key {value} end")], "doc_id long, text string")
    assert secrets.scan_secrets(docs).first()["spans"] == f"entropy:{4 + hot[0]}:{4 + hot[-1] + 20}"


def test_one_case_beside_signs(spark):
    lower, upper = "4q9hqlyjwzrjtt1zxp7kmv3u", "4Q9HQLYJWZRJTT1ZXP7KMV3U"
    forms = [f"{p}{lower}" for p in ("", "sig=", "share/", "sk_live_", "xoxb-", "x/y=z/", "Key=")]
    forms += [f"{p}{upper}" for p in ("KEY-", "key-", "SIG=A/B/")] + [f"{lower}/end", f"a-b_c/{lower}=="]
    forms += ["KEY-DEADBEEF0123456789ABCDEF", "4q9hqlyjwz-rjtt1zxp7k_mv3u8w2n5d"]
    docs = spark.createDataFrame([(i, f"see {x} here") for i, x in enumerate(forms)], "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()}
    for i, form in enumerate(forms):
        found = [tuple(map(int, x.split(":")[1:])) for x in spans[i].split(",") if x]
        assert found, form
        for secret in (lower, upper):
            if secret in form:
                at = 4 + form.index(secret)
                assert min(a for a, _ in found) <= at and max(b for _, b in found) >= at + len(secret), (form, found)
        assert all(4 <= a < b <= 4 + len(form) for a, b in found)
    hidden = {r["doc_id"]: r["text"] for r in secrets.mask_secrets(docs).collect()}
    assert not any(lower in x or upper in x for x in hidden.values())


def test_words_paths_and_numbers_beside_signs_are_spared(spark):
    plain = ["articles/2021/the-long-way-home", "internationalization=localisation", "2024-01-15_12-30-45-000123", "1234567890-1234567890-1234567890"]
    docs = spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")
    assert {r["spans"] for r in secrets.scan_secrets(docs).collect()} == {""}


def test_allow_list_spares_no_base_span(spark):
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    docs = spark.createDataFrame([(1, uuid), (2, f"token={uuid}"), (3, "internationalization-and-localisation-2024")], "doc_id long, text string")
    assert [r["spans"] for r in secrets.scan_secrets(docs).orderBy("doc_id").collect()] == ["", "assign:0:42", ""]


def test_masking(awkward, documents):
    docs = documents((1, 'a password = "abcdefghijkl" b 0123456789abcdef'), (2, None), (3, "clean"))
    found = secrets.mask_secrets(docs)
    assert found.columns == docs.columns
    assert [r["text"] for r in found.orderBy("doc_id").collect()] == ['a [SECRET]" b [SECRET]', None, "clean"]
    assert secrets.mask_secrets(awkward).count() == len(AWKWARD)


def test_awkward_documents(awkward):
    found = secrets.scan_secrets(awkward).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(found) == len(AWKWARD) and {(r["base_sha256"], r["spans"]) for r in found} == {(empty, "")}
    assert secrets.scan_secrets(awkward.limit(0)).collect() == []


def test_no_python_in_the_plan(awkward):
    plan = secrets.scan_secrets(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def entropy_spans(text, window=20):
    """Brute force over one long candidate in mixed case: the hot windows, first to last."""
    counts, total, hot = Counter(), 0.0, []
    cost = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    for i, c in enumerate(text):
        if i >= window:
            out = text[i - window]
            total += cost[counts[out] - 1] - cost[counts[out]]
            counts[out] -= 1
        total += cost[counts[c] + 1] - cost[counts[c]]
        counts[c] += 1
        if i >= window - 1 and math.log2(window) - total / window >= 3.8:
            hot.append(i - window + 1)
    return f"entropy:{hot[0]}:{hot[-1] + window}"


def test_very_long_candidates_and_many_spans(spark):
    rng = random.Random(5)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    picture = "".join(rng.choice(signs) for _ in range(300_000))
    hexes = [f"{rng.getrandbits(80):020x}" for _ in range(20_000)]
    path = "ab/" * 100_000
    texts = [picture, " ".join(hexes), path + "1", path + "x1y2", "Ab1/" * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    began = time.time()
    found = {r["doc_id"]: r for r in secrets.scan_secrets(docs).collect()}
    hidden = {r["doc_id"]: r["text"] for r in secrets.mask_secrets(docs).collect()}
    assert time.time() - began < 150
    assert [x for x in found[0]["spans"].split(",") if x.startswith("entropy")] == [entropy_spans(picture)]
    assert found[1]["n_hex"] == 20_000 and "entropy" not in found[1]["spans"]
    assert hidden[1] == " ".join(["[SECRET]"] * 20_000)
    assert found[2]["spans"] == "" and hidden[2] == texts[2] and found[4]["spans"] == ""


def test_one_span_in_another_and_side_by_side(spark):
    rows = [(1, [(0, 0, 30), (40, 2, 60)], [(5, 3, 25), (0, 3, 30), (20, 3, 35), (40, 3, 61), (70, 3, 90), (72, 3, 88), (70, 3, 80)])]
    spans = "array<struct<start:int,rank:int,end:int>>"
    df = spark.createDataFrame(rows, f"id int, base {spans}, entropy {spans}")
    found = df.select(secrets._uncovered(F.col("base"), F.col("entropy")).alias("x")).first()["x"]
    assert [(r["start"], r["end"]) for r in found] == [(20, 35), (40, 61), (70, 90)]

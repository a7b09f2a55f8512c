"""Fill-in-middle transformation: plain code and round trips."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialtone.llm import fill_middle as M

TEXTS = st.text(alphabet="ab\né€😀<>PSM", max_size=60)


def plain_code(id_, text):
    """(n, form, prefix, middle, output) by slices of the text."""
    digest = hashlib.sha256(f"7:{'' if id_ is None else id_}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.binary(max_size=300), st.data())
def test_rotation_swaps_blocks(raw, data):
    start, mid, end = sorted(data.draw(st.lists(st.integers(0, len(raw)), min_size=3, max_size=3)))
    buffer = bytearray(raw)
    M.rotate(buffer, start, mid, end)
    assert buffer == raw[:start] + raw[mid:end] + raw[start:mid] + raw[end:]


@pytest.mark.parametrize("size", [M.STRIP - 1, 2 * M.STRIP, 5 * M.STRIP + 3])
def test_rotation_over_several_strips(size):
    raw = random.Random(size).randbytes(size)
    buffer = bytearray(raw)
    M.rotate(buffer, 1, size // 3, size - 2)
    assert buffer == raw[:1] + raw[size // 3:size - 2] + raw[1:size // 3] + raw[size - 2:]


@settings(max_examples=300)
@given(TEXTS, st.sampled_from(["psm", "spm"]), st.data())
def test_rearranged_texts_are_restored(text, form, data):
    raw = text.encode()
    if any(x in raw for x in M.Marks().raw()):
        return
    ends = [0, *(k + 1 for k, x in enumerate(raw) if x == 10), len(raw)]
    first, second = sorted((data.draw(st.sampled_from(ends)), data.draw(st.sampled_from(ends))))
    buffer = bytearray(raw)
    M.rearrange(buffer, first, second, form)
    p, m, s = raw[:first], raw[first:second], raw[second:]
    assert buffer == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
    M.restore(buffer, form)
    assert buffer == raw


def test_marks_that_could_be_misread_are_refused():
    for wrong in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P", "<P>", "<M>"), ("ab", "bc", "x")):
        with pytest.raises(ValueError):
            M.Marks(*wrong)
    with pytest.raises(ValueError):
        M.restore(bytearray(b"no sentinel"), "psm")


def test_rows_equal_plain_code(spark):
    r = random.Random(5)
    texts = [None, "", "\n", "\n\n\n", "one line", "ends<", "a\nb<", "x <P> y\nz", "é\n😀\nß", "same\ntext", "same\ntext",
             "long " * 200_000 + "\n" + "tail " * 100_000]
    texts += ["\n".join(r.choices(["", "é", "word word", "<", "P>", "😀"], k=r.randrange(1, 9))) for _ in range(60)]
    rows = [(k if k else None, t, "x", k) for k, t in enumerate(texts)] + [(9, "same\ntext", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")  # names that the struct has inside
    done = M.fill_middle(docs)
    assert done.columns == ["doc_id", "text", "form", "n", "fim"]
    got = done.withColumn("back", M.restored(F.col("fim.text"), F.col("fim.form"))).collect()
    assert len(got) == len(rows)
    for row in got:
        text = row["text"] or ""
        assert tuple(row["fim"]) == plain_code(row["doc_id"], text)
        assert row["back"] == text
    assert M.fill_middle(docs.where("false")).count() == 0
    clash = M.fill_middle(docs.withColumnRenamed("n", "fim"))
    assert clash.columns == ["doc_id", "text", "form", "fim"] and clash.where("fim.text is null").count() == 0


def test_rates(spark):
    docs = spark.createDataFrame([(k, "a\nb\n") for k in range(400)], "doc_id long, text string")
    forms = {r["form"]: r["count"] for r in M.fill_middle(docs, fim_percent=50, spm_percent=25).groupBy("fim.form").count().collect()}
    assert 150 < forms["plain"] < 250 and 20 < forms["spm"] < 80 and forms["spm"] < forms["psm"]

"""Charsets found by bytes: what wins against trying every charset and language in full, and the work that finding it takes."""

import random
import re
import time

from pyspark.sql import functions as F

from claimloom.functions import charset as C

HIGH, LEADS = "[\x80-\xff]", "[\x81-\x9f\xe0-\xfc]"


def plainly(body):
    """The best of all charsets and languages, each tried on all neighbours."""
    s = body.decode("latin-1")
    beside = " ".join(re.findall(f"[^\x80-\xff]?{HIGH}+[^\x80-\xff]?", s, re.S))
    n_high, found = len(re.findall(HIGH, s)), []
    for at, (name, languages) in enumerate(C.CHARSETS.items()):
        for letters in languages:
            t = beside.translate(str.maketrans(C.BYTES + C.ASCII_LETTERS, C._classes(name, letters) + C.ASCII_CLASSES))
            of = lambda kinds, t=t: sum(map(t.count, kinds))
            total = of("gG") + 0.5 * of("rR") - of("ws") - 2 * of("c") - 2 * len(re.findall("(?<=[lgr])[GR]|(?<=[lLgr])[spc](?=[lgr])", t))
            total -= len(re.findall("(?<=[lL])[gGwrR]|[gGwrR](?=[lL])", t)) if name in C.DENSE else 0.25 * len(re.findall("[gGw](?=[gGw])", t))
            found.append((total / n_high, -at, name))
    pairs = re.findall(f"{LEADS}[\x40-\x7e\x80-\xfc]", s, re.S)
    firm, lettered = (sum(re.fullmatch(p, x) is not None for x in pairs) for p in (C.FIRM, C.LETTERED))
    stray = len(re.findall(HIGH, re.sub(f"{LEADS}[\x40-\x7e\x80-\xfc]|[\xa1-\xdf]", "", s)))
    found.append(((3.0 * (firm + min(firm, lettered)) - len(pairs) - 4.0 * stray) / n_high, -len(C.CHARSETS), "shift_jis"))
    return max(found)[2]


def test_the_best_of_all_charsets_wins(spark):
    draw, texts = random.Random(4), ["Le cœur de l'élève, « français » à 5 €", "ŠČŘ příliš žluťoučký kůň", "ZAŻÓŁĆ gęślą jaźń", "Hűvös őszi délután", "Это сообщение ложное", "この画像は別の事件", "größere Mengen – „falsch“"]
    bodies = [bytes(draw.choice(b"aL e\x83A\xe9\xe8\x82\xa0\x9a\xbe\xd0\xc1\x97\xfa") for _ in range(draw.choice([3, 7, 25, 61]))) for _ in range(150)]
    for _ in range(150):
        words = " ".join(draw.choice(texts) for _ in range(draw.randint(1, 4)))
        body = bytearray(words.encode(draw.choice([*C.CHARSETS, "cp932"]), errors="ignore") + b"\xe9")
        body[draw.randrange(len(body))] = draw.choice(b"aZ 0\x80\xa4\xc4\xf6\x99\x88")
        bodies.append(bytes(body))
    bodies = [b for b in dict.fromkeys(bodies) if re.search(rb"[\x80-\xff]", b)]
    df = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k long, body binary")
    found = {r.k: r.found for r in df.select("k", C._single_byte(C.latin(F.col("body"))).alias("found")).collect()}
    assert {bodies[k]: x for k, x in found.items()} == {b: plainly(b) for b in bodies}


def test_long_texts_are_not_read_for_every_language(spark):
    body = "この事件はべつのもの".encode("cp932") * 40_000  # 0.8 MB
    df = spark.createDataFrame([(body,)], "body binary").cache()
    df.count()

    def seconds(col):
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            df.select(col.alias("x")).agg(F.max("x")).collect()
            runs.append(time.perf_counter() - began)
        return min(runs)

    # a search of all characters, one at a time; all charsets and languages in full took 34 of them or more, this takes 2 to 3
    once = seconds(F.length(F.regexp_replace(C.latin(F.col("body")), "(?s)(.)", "$1")))
    assert seconds(C.detected(F.col("body"))) < 12 * once

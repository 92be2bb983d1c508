import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from candlewright.llm import fertility as op
from candlewright.llm.queries import BYTE_BPE, PIECES, vocabularies


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, duplicates = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered), failed


def brute_measures(text):
    content = open(public_tokenizers.path(BYTE_BPE), "rb").read()
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op.ranks_of(content), special_tokens={})
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tokens = [t for w in words for t in encoding.encode_ordinary(" " + w)]
    found = [t for w in words for t in model.encode(w)]
    n = len(tokens)
    return n, sum(map(len, words)) / n, sum(map(model.is_byte, found)) / len(found), -sum(c / n * math.log2(c / n) for c in Counter(tokens).values())


def test_measures_same_as_brute_force(spark, docs_of):
    rng = random.Random(4)
    vocabulary = ["the", "walk***", "été", "naïve", "&amp;", "|", "x" * 300, "猫", "𒀀", "Straße", "<b>", "#1"]
    texts = [None, "", " \n\t", "one", "a\x0bb\x0cc d e\r\nf", "same line\nsame line\n\n \n \nsame line", "w " * 5000, " ".join(f"w{i % 9}" for i in range(40))]
    texts += ["".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "  "]) for _ in range(rng.randrange(1, 400))) for _ in range(40)]
    block = " ".join(f"b{i}" for i in range(12))
    texts += [f"{block} {' '.join(f'u{i}' for i in range(60))} {block} tail"]
    rows = [(i, t, [None, "en", "xx"][i % 3]) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r for r in op.quality(docs_of(rows).withColumn("kept", op.F.lit("clash")), vocabularies(spark)).collect()}
    assert len(found) == len(rows)
    for i, text in enumerate(texts):
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_base(text)
        assert not (r["base_failed"] and r["kept"])
        if r["n_words"]:
            want = brute_measures(text)
            assert r["n_tokens"] == want[0]
            assert (r["chars_per_token"], r["byte_share"], r["token_entropy"]) == pytest.approx(want[1:])


def test_verdict_by_language_and_script(spark, docs_of):
    plain = "It was a bright cold day in April and the clocks were striking thirteen while winds blew dust along the street below"
    russian = "Все счастливые семьи похожи друг на друга каждая несчастливая семья несчастлива по своему всё смешалось в доме жена узнала что муж был в связи"
    rows = [(1, plain, "en"), (2, plain, None), (3, russian, "ru"), (4, " ".join(["zq#%&"] * 3 + [f"q{i}#%$" for i in range(60)]), "en"), (5, " ".join("𒀀𒁀𒂀" for _ in range(30)), "en")]
    docs = docs_of(rows).withColumn("c1", op.F.lit(1))
    told = {r["doc_id"]: (r["kept"], r["band"]) for r in op.quality(docs, vocabularies(spark)).collect()}
    assert told[1] == (True, "en") and told[2] == (True, "Latin") and told[3] == (True, "Cyrillic")
    assert not told[4][0] and not told[5][0]
    stay = op.drop_rejected(docs, vocabularies(spark))
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == [1, 2, 3]


def test_empty_table(spark, docs_of):
    assert op.quality(docs_of([]), vocabularies(spark)).count() == 0
    assert op.drop_rejected(docs_of([]), vocabularies(spark)).count() == 0


def test_short_clean_texts_stay(spark, docs_of):
    texts = [
        "The old bridge over the river was closed for the winter, and the people of the town had to walk around the hill.",
        "We walked to the market in the morning and bought bread, apples and a little cheese for the children of the house.",
        "The members of the committee said that the work of the committee on the road to the north of the town was done.",
        "It was late when the last of the boats came in, and the men on the quay were tired of the wind and of the rain that had come "
        "with the night, but the one who had the key to the shed was not there.",
    ]
    assert any(brute_measures(text)[3] < 4.3 for text in texts[:3])
    rows = [(i, text, lang) for i, (text, lang) in enumerate((t, lang) for t in texts for lang in ("en", None))]
    assert all(r["kept"] for r in op.quality(docs_of(rows), vocabularies(spark)).collect())


def test_entropy_floor_grows_with_length(spark, docs_of):
    for band in (*op.LANGUAGE_BANDS.values(), *op.SCRIPT_BANDS.values()):
        floors = [band.entropy_floor(n) for n in range(op.MIN_WORDS, 400)]
        assert floors == sorted(floors) and floors[0] < math.log2(op.MIN_WORDS) - 1 and floors[-1] == band.full_entropy
    rng = random.Random(1)
    dull = [(0, " ".join(rng.choices("the cat sat on".split(), k=24)), "en"), (1, " ".join(rng.choices("the cat sat on a mat and ran to it".split(), k=400)), "en")]
    assert not any(r["kept"] for r in op.quality(docs_of(dull), vocabularies(spark)).collect())

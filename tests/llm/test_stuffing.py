"""Suffix automata and stuffed pages."""

import codecs
import pathlib
import random
import textwrap

import pytest

pytest.importorskip("millrace.llm")

from millrace.llm import stuffing as S  # noqa: E402


@pytest.mark.parametrize("seed", range(6))
def test_automaton_matches_brute_force(seed):
    rng = random.Random(seed)
    t = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(40)]
    subs = {}
    for i in range(len(t)):
        for j in range(i + 1, len(t) + 1):
            subs[tuple(t[i:j])] = subs.get(tuple(t[i:j]), 0) + 1
    want = [max([n for n in range(1, i + 2) if subs[tuple(t[i + 1 - n : i + 1])] > 1], default=0) for i in range(len(t))]
    assert S.Automaton.of(t).repeats == want


PROSE = "The ligand library was split into 55 parts, each with at most 310 entries. A second operator could not open the file, so the pose was read from the copy instead. "
SPAM = {
    "keywords": "drug discovery service best screening buy compound drug discovery service best screening " * 8,
    "counts": "assay kit (360)\nbinding affinity (98)\nligand library (510)\nlab discount (31)\nbuy compound (7)\nassay kit (12)\npeptide online (5)\n",
    "tags": "tags: assay kit, buy compound, best screening; category: assay kit; brand: dockhub;\n" * 5,
    "hashes": " ".join(f"#buy_compound{i}" for i in range(20)),
    "links": "\n".join(f"https://shop{i}.kinet.example/a/b{i}" for i in range(12)),
    "anchors": "\n".join(f'<a href="http://x{i}.example/q={i}">best screening</a>' for i in range(9)),
    "products": "\n".join(f"SKU-{i}77 buy compound 10 mg USD {i}.99 in stock" for i in range(9)),
    "disguised": "drug disc0very service kinаse inhibit0r cheаp IC50 test drug discovery service kinase inhibitor cheap IC50 test " * 4,
    "stuffed sentences": "Online kinase inhibitor with assay kit buy for your assay kit! Kinase inhibitor best assay kit online for your kinase inhibitor buy! " * 5,
    "other script": "激酶抑制剂 (873)\n蛋白质价格 (733)\n试剂盒购买 (275)\n化合物库 (865)\n试剂盒购买 (368)\n激酶抑制剂 (89)\n激酶抑制剂 (974)\n免费送货 (602)\n对接软件 (357)\n",
}
FINE = {
    "prose": PROSE * 6,
    "log": "".join(f"[12:{i:02d}:16] INFO pose {i} accepted\n" for i in range(40)),
    "table": "CID\tname\tvalue\n" + "".join(f"70000{i}\tIC50\t{i}.5\n" for i in range(40)),
    "atoms": "".join(f"ATOM {i} CB ASN B {i} -29.257 26.433 20.819\n" for i in range(40)),
    "sequence": ">8XDEBC_1\n" + "HLKEMGNSVQWKHRKIIYRPCTMVRTHRGDWKKYSAHLPMMSWIWFESVY\n" * 6,
    "structures": "c1cc(Cl)c(C(=O)O)cc1 7000025966_55\n" * 20,
    "settings": "dock:\n" + "  seed: 55\n  ff: 44\n" * 20,
    "files": "".join(f"61448 blocks/3K8DUH/70000{i}_u4_docked.sdf\n" for i in range(30)),
    "references": "References\n" + "".join(f"[{i}] Tarvel M., Okimbe L. On rescoring of a buried loop. Notes on proteases 6, {i} (2009). https://x.example/p/{i}\n" for i in range(15)),
    "remark": "ok ok",
    "little of it": PROSE * 4 + "\n" + "assay kit buy compound assay kit buy compound",
    "chinese": "结构8BMS8F的分辨率为2.7 Å,口袋附近有水分子。我们检查了36个构象,保留了其中7个。" * 5,
}


SPAM["one sentence again and again"] = "Buy the best kinase inhibitor online at our shop and get free shipping today. " * 20


def license_text(name):
    path = pathlib.Path("/usr/share/common-licenses") / name
    if not path.is_file():
        pytest.skip("no such text here")
    return path.read_text(errors="ignore")


@pytest.mark.parametrize("name", ["GPL-3", "Apache-2.0", "LGPL-2.1", "MPL-2.0", "BSD"])
def test_prose_in_any_language_wrapped_or_not(name):
    text = license_text(name)
    joined = "\n\n".join(" ".join(p.split()) for p in text.split("\n\n"))
    wrapped = "\n\n".join(textwrap.fill(p, 72) for p in joined.split("\n\n"))
    for t in (text, joined, wrapped):
        assert S.stuffed_share(t)[0] < S.SHARE
        assert S.stuffed_share(codecs.encode(t, "rot13"))[0] < S.SHARE


def test_manual_pages_are_no_spam():
    topics = pytest.importorskip("pydoc_data.topics").topics
    assert [k for k, t in topics.items() if S.stuffed_share(t)[0] >= S.SHARE] == []


@pytest.mark.parametrize("ends", [True, False])
def test_the_length_of_a_page_does_not_decide(ends):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
    for n in (300, 1000, 3000, 10_000):
        words = rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n)
        sentences = [" ".join(words[i : i + 15]).capitalize() for i in range(0, n, 15)]
        assert S.stuffed_share((". " if ends else " ").join(sentences) + ".")[0] < 0.2
        keywords = [rng.choice(vocabulary[:30]) + " " + rng.choice(vocabulary[30:34]) for _ in range(n // 2)]
        assert S.stuffed_share(" ".join(keywords))[0] >= S.SHARE


def test_wrapped_lines_are_joined_and_lists_are_not():
    text = "The ligand library was split into parts, each of them with at most as many entries as a worker holds in its memory."
    assert S.unwrapped(textwrap.fill(text, 50).split("\n")) == [(text, False)]
    items = ["buy compound online", "best screening", "cheap assay kit with free shipping today"]
    assert S.unwrapped(items) == [(x, False) for x in items]


@pytest.mark.parametrize("name", SPAM)
def test_stuffed(name):
    share, n = S.stuffed_share(SPAM[name])
    assert share >= S.SHARE and n >= S.LEAST_CHARS
    assert S.stuffed_share(SPAM[name], S.SHARE) == (share, n)
    assert S.stuffed_share(PROSE + "\n" + SPAM[name] * 3)[0] >= S.SHARE
    assert S.stuffed_share(SPAM[name].upper())[0] >= S.SHARE


@pytest.mark.parametrize("name", FINE)
def test_not_stuffed(name):
    share, n = S.stuffed_share(FINE[name])
    assert share < S.SHARE or n < S.LEAST_CHARS


def test_sentences_are_judged_until_the_share_is_out_of_reach(monkeypatch):
    judged = []
    monkeypatch.setattr(S, "_structure", lambda text, structure=S._structure: judged.append(text) or structure(text))
    prose = " ".join(f"In week {i} the {w} group moved its {w} samples to another cold room of the institute." for i, w in enumerate("alpha beta gamma delta kappa omega sigma theta lambda epsilon".split()))
    assert S.stuffed_share(prose, S.SHARE) == (0.0, 0) and len(judged) == 6  # of ten: the longest six are more than 0.6 of the page
    assert S.stuffed_share(prose)[0] == 0.0


@pytest.mark.parametrize("name", [*SPAM, *FINE])
def test_the_bound_changes_no_verdict(name):
    for text in ({**SPAM, **FINE}[name], PROSE + {**SPAM, **FINE}[name], PROSE * 7 + "\n" + {**SPAM, **FINE}[name]):
        share, n = S.stuffed_share(text)
        for least in (0.1, S.SHARE, 0.9):
            assert S.stuffed_share(text, least) in [(share, n), (0.0, 0)][: 1 + (share < least)]


def test_ascii_signs_and_words_are_those_of_any_text():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices("abez'_09  \t,;:>/|-+*~().#!?", k=rng.randint(0, 40)))
        assert S._signs(text) == len(S._SIGNS.findall(text)) and S._ASCII_WORDS.findall(text) == S._WORDS.findall(text)


def test_tables(spark):
    rows = [(1, SPAM["keywords"], "c"), (2, PROSE, "c"), (3, None, "c"), (4, "", "c"), (5, " \n\t", "c"), (6, SPAM["keywords"], "c"), (7, SPAM["links"] * 300, "c"), (8, "x" * 200_000, "c"), (None, SPAM["tags"], "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, share string")
    assert {r.doc_id for r in S.stuffed_pages(df).collect()} == {1, 6, 7, None}
    assert S.stuffed_pages(df.limit(0)).count() == 0

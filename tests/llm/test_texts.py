"""Encoding, site lines, defects and spam pages."""

import itertools
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftwork.llm import defects, encode, site_lines, spam_pages

ENC = encode.encoder(encode.default_vocabulary())
REF = tiktoken.Encoding("reference", pat_str=encode.PATTERN, mergeable_ranks=ENC.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab ż9.,'\n\t\r  ́½\U0001f600<|>els", max_size=40))
def test_ids_are_those_of_the_public_library(text):
    assert ENC.encode(text) == REF.encode_ordinary(text)


def test_long_pieces_and_bytes_come_back():
    rng = random.Random(1)
    for text in ("ab" * 30_000, "".join(rng.choices("abcż", k=20_000)), "<|endoftext|> x"):
        ids = ENC.encode(text)
        assert ids == REF.encode_ordinary(text) and REF.decode(ids) == text


def test_encode_corpus(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, None), (3, "", "x"), (1, "a b", "x")], "doc_id bigint, text string, ids string")
    got = encode.encode_corpus(df)
    assert got.columns == ["doc_id", "text", "ids"]
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == [(1, ENC.encode("a b"))] * 2 + [(2, []), (3, [])]
    assert encode.encode_corpus(df.where("false")).count() == 0


def forum(spark, rows):
    return spark.createDataFrame(rows, "source string, thread_id bigint, posts array<struct<index:int,content:string>>, key string")


def test_site_lines_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for t in range(120):
        source = "a" if t % 4 else "b"
        posts = []
        for k in range(rng.randint(1, 4)):
            lines = [f"tekst {rng.random()}"]
            if rng.random() < 0.2:
                lines.append(rng.choice(["Czytano 5 razy", "CZYTANO  77 razy ", "Czytano 3​ razy"]))
            if rng.random() < 0.03:
                lines.append("rzadka")
            posts.append((k, rng.choice(["\n".join(lines), None, ""]) if rng.random() < 0.1 else "\n".join(lines)))
        rows.append((source, t, posts, "clash"))
    rows += [rows[0], ("a", None, [(0, "x")], ""), (None, 999, [(0, "x")], ""), ("a", 1000, None, ""), ("a", 1001, [(0, "rzadka\n" * 9)], "")]
    posts, seen = {}, {}
    for s, t, ps, _ in rows:
        if s and t is not None and ps:
            for i, c in ps:
                posts[s, t, i] = c
    for (s, t, i), c in posts.items():
        for n, line in enumerate((c or "").split("\n"), 1):
            if k := site_lines.line_form(line):
                seen.setdefault((s, k), []).append((t, i, n))
    total = {s: sum(k[0] == s for k in posts) for s in "ab"}
    want = {x for (s, k), at in seen.items() if len({a[:2] for a in at}) >= max(5, 0.05 * total[s]) for x in at}
    df = forum(spark, rows)
    assert {(r.thread_id, r.post_index, r.line_no) for r in site_lines.site_lines(df).collect()} == want and want
    clean = {(r.thread_id, r.post_index): r for r in site_lines.without_site_lines(df).collect()}
    assert sum(r.n_removed for r in clean.values()) == len(want)
    assert not any("zytano" in (r.content or "") for r in clean.values())
    assert site_lines.site_lines(df.where("false")).count() == 0 and site_lines.without_site_lines(df.where("false")).count() == 0


def test_summaries_keep_every_frequent_line():
    rng = random.Random(3)
    s = site_lines.Summary(0.05)
    for i in range(3000):
        s.add({rng.getrandbits(60) for _ in range(5)} | ({-1} if i % 18 == 0 else set()))
    assert len(s.counts) <= 2 * site_lines.COUNTERS
    s.cut(site_lines.COUNTERS)
    assert len(s.counts) <= site_lines.COUNTERS and s.lost < 0.025 * s.posts
    assert s.counts[-1] + s.lost >= 3000 / 18


def test_merged_summaries_stay_small_and_keep_every_frequent_line():
    rng = random.Random(4)
    parts = [site_lines.Summary(0.05) for _ in range(40)]
    for i in range(12_000):
        parts[i % 40].add({rng.getrandbits(60) for _ in range(5)} | ({-1} if i % 18 == 0 else set()))
    merged = site_lines.Summary(0.05)
    for s in parts:
        s.cut(site_lines.COUNTERS)
        merged.merge(s.counts.keys(), s.counts.values(), s.lost, s.lines, s.posts)
    assert (merged.posts, merged.lines) == (12_000, sum(s.lines for s in parts))
    assert len(merged.counts) <= site_lines.COUNTERS and merged.lost < 0.025 * merged.posts
    assert merged.counts[-1] + merged.lost >= 12_000 / 18


PL = "Niech n będzie liczbą naturalną. Pokaż, że liczba ta jest parzysta, jeżeli suma jej cyfr jest podzielna."
ANSWER = "Suma cyfr jest parzysta, więc liczba jest parzysta. Stąd teza, co należało pokazać."


@pytest.mark.parametrize(
    ("question", "solution", "reason", "first"),
    [
        (PL, None, "ok", "empty"),
        (PL, "  \n", "ok", "empty"),
        (PL, "(brak)", "ok", "empty"),
        (PL, "**Rozwiązanie:**", "ok", "empty"),
        (PL, "\\text{}", "ok", "empty"),
        (PL, "0", "ok", None),
        (PL, "Tak.", "ok", None),
        (PL, "$x=3$", "ok", None),
        (PL, "Odp. 12", "ok", None),
        (PL, "c.n.d.", "ok", None),
        (PL, ANSWER, "Zadanie kompletne, nie można mieć zastrzeżeń.", None),
        (PL, ANSWER, "I can see a complete statement with one unknown.", None),
        (PL, ANSWER, "Odmawiam oceny tej treści.", "refusal"),
        (PL, "Witaj! Nie mogę pomóc w rozwiązaniu tego zadania.", "", "refusal"),
        (PL, "I'm sorry, but I can't help with that request.", "", "refusal"),
        (PL, "Es tut mir leid, dabei kann ich nicht helfen.", "", "refusal"),
        (PL, "На жаль, я не можу допомогти з цим завданням.", "", "refusal"),
        (PL, "Nie możemy tu dzielić przez zero, dlatego odejmujemy $x=3$. Stąd teza.", "", None),
        (PL, "Treść: " + PL, "", "copy"),
        (PL, PL.lower() + " .?", "", "copy"),
        (PL, PL + "\n" + PL, "", "copy"),
        ("Zadanie znalazłem w domu i nie wiem, jak ruszyć sumę.", "Zadanie znalazłem w domu i nie wiem, jak ruszyć sumę.", "", "copy"),
        (PL, "Mamy treść: " + PL + "\n" + ANSWER, "", None),
        (PL, ANSWER + " Zatem $f(", "", "truncated"),
        (PL, ANSWER + " Korzyst", "", "truncated"),
        (PL, ANSWER + "\nKrok 3:", "", "truncated"),
        (PL, ANSWER + " Z [...", "", "truncated"),
        (PL, ANSWER + "\n2.", "", "truncated"),
        (PL, ANSWER + " Odp. $\\frac{1}{2}$", "", None),
        (PL, ANSWER + " A więc $x^2$. ∎", "", None),
        (PL, "We check that the sum is even, so the number is even. By the definition of the set this gives the claim.", "", "language"),
        (PL, ANSWER + " By the definition this is even. Dlatego liczba jest parzysta i nie ma innych.", "", None),
        (None, ANSWER, None, None),
    ],
)
def test_defects(question, solution, reason, first):
    got = defects.defects_of(question, solution, reason)
    assert (got[0] if got else None) == first, got


def test_pair_defects(spark):
    df = spark.createDataFrame([(1, PL, None, "x", 5), (1, PL, None, "x", 5), (2, PL, ANSWER * 2000, None, 6), (3, None, None, None, 7)], "record_id bigint, question string, solution string, filter_reason string, defects int")
    got = sorted((r.record_id, r.defects) for r in defects.pair_defects(df).collect())
    assert got == [(1, ["empty"]), (1, ["empty"]), (2, []), (3, ["empty"])]
    assert defects.pair_defects(df.where("false")).count() == 0


_RNG = random.Random(9)
_STEMS = "liczba suma granica krzywa prosta funkcja macierz reszta pochodna wektor okrąg cięciwa odcinek kula grupa ideał norma zbiór ciąg wykres iloraz pole kąt trójkąt stożek walec".split()
_VERBS = "jest daje wynosi zależy ma przecina dzieli ogranicza zawiera wyznacza".split()
PROSE = " ".join(f"{_RNG.choice(('Stąd', 'Zatem', 'Niech', 'Wtedy'))} {' '.join(_RNG.sample(_STEMS, 2))} {_RNG.choice(_VERBS)} {_RNG.choice(_STEMS)}, gdy {_RNG.choice(_STEMS)} nie {_RNG.choice(_VERBS)} od {i}." for i in range(14))
PAGES = {
    "prose": (PROSE, False),
    "links": ("\n".join(f"https://sklep{i}.example/toner/{i}" for i in range(30)), True),
    "anchors": ("Rysunek pomaga, bo punkt leży na prostej.\n" + " ".join(f'<a href="http://top{i}.test/x">krem tani</a>' for i in range(30)), True),
    "tags": (" ".join(f"#kreda{i}tanie" for i in range(60)), True),
    "words": ("matura perfumy rower okazja monitor " * 40, True),
    "dressed": ("Szukasz matura rabat? U nas matura rabat to najlepsze matura rabat. Kup matura rabat, zamów matura rabat. " * 8, True),
    "prices": ("\n".join(f"toner kreda hurt {i}5,99 zł" for i in range(30)), True),
    "exercises": ("\n".join(f"{i}. Oblicz $x^{i}+{i}x=3$ dla liczby {i} oraz podaj pochodną funkcji." for i in range(20)), False),
    "table": (PROSE + "\n" + "\n".join(f"{i} | {i * 7} | $\\det M={i}$" for i in range(20)), False),
    "sources": (PROSE + "\n" + "\n".join(f"Norma {w}, skrypt, https://biblioteka{i}.example/s{i}" for i, w in enumerate("zerowa stała zwarta pełna".split())), False),
    "empty": ("", False),
    "blank": (" \n\t", False),
    "null": (None, False),
}


def test_spam_pages(spark):
    df = spark.createDataFrame([(k, t, "clash") for k, (t, _) in PAGES.items()] + [("prose", PROSE, "clash")], "doc_id string, text string, spam string")
    got = spam_pages.spam_pages(df)
    assert [(r.doc_id, r.spam) for r in got.collect() if r.spam != PAGES[r.doc_id][1]] == []
    assert got.count() == len(PAGES) + 1
    assert spam_pages.spam_pages(df.where(F.lit(False))).count() == 0


def coded_pages(rng, n=40):
    return [spam_pages.codes_of(spam_pages.page_lines("\n".join(rng.choice([PROSE[:80], "https://a.example/b", "#a #b", "x $y$"]) for _ in range(rng.randint(0, 9))))[0]) for _ in range(n)]


def test_decoding_is_that_of_plain_viterbi():
    model = spam_pages.Model.prior()
    start, moves, lines = np.log(model.start), np.log(model.moves), np.log(model.lines).astype(np.float32)

    def plain(page):
        if not len(page):
            return []
        best = [(start[s] + lines[page[0]][s], [s]) for s in range(4)]
        for code in page[1:]:
            best = [max((p + moves[path[-1]][s] + lines[code][s], [*path, s]) for p, path in best) for s in range(4)]
        return max(best)[1]

    pages = coded_pages(random.Random(5))
    assert [list(x) for x in spam_pages.decode(model, pages)] == [plain(p) for p in pages]


def test_expected_counts_are_those_of_all_paths():
    model = spam_pages.Model.prior()
    pages = [p for p in coded_pages(random.Random(7), 30) if len(p) < 6]
    start, moves, lines = np.zeros(4), np.zeros((4, 4)), np.zeros((len(model.lines), 4))
    for page in pages:
        paths = list(itertools.product(range(4), repeat=len(page))) if len(page) else []
        chance = np.array([model.start[p[0]] * np.prod([model.moves[a, b] for a, b in itertools.pairwise(p)]) * np.prod([model.lines[c, s] for c, s in zip(page, p, strict=True)]) for p in paths])
        for path, w in zip(paths, chance / chance.sum() if len(chance) else [], strict=True):
            start[path[0]] += w
            for a, b in itertools.pairwise(path):
                moves[a, b] += w
            for c, s in zip(page, path, strict=True):
                lines[c, s] += w
    want = np.concatenate([start, moves.ravel(), lines.ravel(), [sum(len(p) > 0 for p in pages)]])
    assert np.allclose(model.expected(pages), want) and np.allclose(sum(model.expected([p]) for p in pages), want)


def test_the_model_is_the_same_for_ten_times_the_pages(spark):
    rows = [(str(k), t) for k, (t, _) in enumerate(PAGES.values())]
    one, ten = (spam_pages.fit(spam_pages.seen_lines(spark.createDataFrame(rows * n, "doc_id string, text string"), ["doc_id"], "text").cache()) for n in (1, 10))
    assert np.allclose(one.lines, ten.lines) and np.allclose(one.moves, ten.moves)
    assert np.allclose(spam_pages.fit(spam_pages.seen_lines(spark.createDataFrame([], "doc_id string, text string"), ["doc_id"], "text")).moves, spam_pages.Model.prior().moves)


def test_a_display_left_open_on_an_earlier_line_is_truncated():
    from siftwork.llm.defects import is_truncated

    for begin in ("\\[", "$$", "\\begin{cases}", "Niech $a$ oraz\n$$"):
        assert is_truncated(f"Zatem mamy\n{begin}\nx = 5"), begin
    for whole in ("\\[\nx = 5\n\\]", "$$\nx = 5\n$$", "\\begin{cases}\nx = 5 \\\\[2pt]\ny = 3\n\\end{cases}", "Cena 5$ oraz\n$a$$b$ = 5"):
        assert not is_truncated(f"Zatem mamy\n{whole}"), whole


QUESTION_5 = "Wykaż, że dla każdej liczby naturalnej n liczba $n(n+1)$ jest parzysta, a jej kwadrat dzieli się przez 4."


def first_defect(solution, question=QUESTION_5, reason="ok"):
    return next(iter(defects.defects_of(question, solution, reason)), None)


def test_copies_at_any_number_of_repeats():
    for times in (1, 2, 3, 7, 12, 60):
        assert first_defect(" ".join([QUESTION_5] * times)) == "copy", times
        assert first_defect("Treść: " + "\n".join([QUESTION_5] * times)) == "copy", times
    assert first_defect(QUESTION_5 + " Jedna z liczb n, n+1 jest parzysta, więc ich iloczyn też, a kwadrat iloczynu ma dwa takie czynniki.") is None


def test_refusals_of_any_length_and_place():
    thanks = "Dziękuję za ciekawe pytanie i za zaufanie, bardzo to doceniam. " * 8
    declined = "Niestety nie mogę pomóc w rozwiązaniu tego zadania. "
    for text in (declined, thanks + declined, declined + thanks * 3, QUESTION_5 + " " + declined, declined * 40):
        assert first_defect(text) == "refusal", text[:80]
    for text in (
        "Sinto muito, mas não posso ajudar com esse pedido.",
        "Üzgünüm, bu soruya yardımcı olamam.",
        "申し訳ありませんが、このご質問にはお答えできません。",
        "Het spijt me, ik kan deze vraag niet beantwoorden.",
        "抱歉，我无法回答这个问题。",
        "Es tut mir leid, das kann ich nicht beantworten.",
        "Désolé, je ne peux pas répondre.",
    ):
        assert first_defect(text) == "refusal", text
    assert first_defect("x", reason="Não posso responder a isso.") == "refusal"
    # a solution that declines one step of its work
    assert first_defect("Nie mogę zrobić tego dzieleniem przez $n$, bo $n=0$ jest możliwe. Niech $n=2k$, wtedy $n(n+1)=2k(2k+1)$. Niech $n=2k+1$, wtedy $n(n+1)=2(2k+1)(k+1)$. Koniec.") is None


def test_every_refusal_phrase_has_a_stem():
    for text in ("Odmawiam oceny.", "jako sztuczna inteligencja", "I must politely decline.", "as an assistant", "I am unable to judge this", "ich werde das nicht tun", "не можу вам допомогти", "não consigo resolver", "çözemiyor", "お手伝いできません", "lo siento"):
        assert defects.REFUSALS.search(text) and any(x in text.lower() for x in defects.STEMS), text


def test_solutions_in_unknown_languages():
    italian = "Sia n un numero naturale qualsiasi. Uno dei numeri consecutivi è pari, quindi il prodotto è pari e il suo quadrato è divisibile per quattro. Questo conclude la dimostrazione."
    finnish = "Olkoon luku mielivaltainen. Toinen peräkkäisistä luvuista on parillinen, joten tulo on parillinen, ja sen neliö on jaollinen neljällä, koska siinä esiintyy kaksi kertaa tekijä kaksi. Todistus päättyy."
    japanese = "連続する二つの整数のうち一方は偶数である。したがって積は偶数であり、その二乗は四で割り切れる。"
    for text in (italian, finnish, japanese):
        assert first_defect(text) == "language", text
    assert first_defect("$n(n+1)$ jest parzysta.") is None
    assert first_defect("\\[" + "n" * 5000 + "\\] Zatem liczba jest parzysta.") is None
    long_formula = "\\(" + " the of and that we is with by".ljust(3000) + "\\)"
    assert defects.without_formulas("a " + long_formula + " b").split() == ["a", "b"] and defects.without_formulas("\\( a").split() == ["\\(", "a"]


def test_empty_solutions_of_any_length():
    for text in (None, "", "  ", "**Rozwiązanie:**", "brak " * 40, "Odp." + " " * 90, "<p class='a b c'></p>" * 20, "$$ $$", "." * 500):
        assert first_defect(text) == "empty", text
    assert first_defect("7") is None and first_defect("tak") is None

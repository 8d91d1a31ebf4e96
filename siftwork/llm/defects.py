"""Problem 5: broken prompt and response pairs.

Ordered rules over each pair, each over whole texts of any length: emptiness, refusal phrases of several languages, copied prefix,
unclosed delimiters and abrupt endings, script and language mismatch.  ``pair_defects`` emits
every defect whose rule fires; ``first`` is the one that explains the pair (a copy that breaks
off is a copy, a refusal in another language a refusal).  A map over Arrow batches, no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm import cleanup

ORDER = ("empty", "refusal", "copy", "truncated", "language")

#: Words that stand for a missing answer.
PLACEHOLDERS = frozenset(
    "null none nil nan na n/a n/d nd brak b/d bd no_answer noanswer no-answer tbd todo tba empty puste pusty undefined missing text answer solution "
    "brak_odpowiedzi placeholder keine leer нет немає відсутня".split()
)
#: Headings under which an answer would stand.
HEADINGS = frozenset(
    "odp odpowiedź odpowiedz rozwiązanie rozwiazanie dowód dowod szkic wskazówka wynik solution answer proof hint sketch result ans sol lösung antwort beweis розв'язання розвязання відповідь доведення решение ответ réponse solución respuesta".split()
)
_MARKUP = re.compile(r"<[^<>]*>|\\(?:text|textbf|mathrm|boxed|begin|end|displaystyle|quad|,|;)|[*#_`>~]|\$|\\[()\[\]]|[{}]")

#: Phrases by which a job is declined; the second group counts only in texts that do no mathematics.
REFUSALS = re.compile(
    r"nie (?:mogę|jestem w stanie|potrafię|wolno mi|umiem|będę w stanie|podejmę się|udzielę|odpowiem|rozwiążę|ocenię) (?:\w+ ){0,4}?(?:pom|odpow|rozwiąz|oceni|udziel|tego|tej|treści|zadani|pytani|prośb|zrobi|wykona|spełni)"
    r"|nie (?:udzielę|podejmę się|rozwiążę)\b|(?:muszę|jestem zmuszon\w+) odm[oó]wi|\bodmawiam\b|wykracza poza to, co|jako model językowy|jako (?:asystent|sztuczna inteligencja|ai)\b"
    r"|przykro mi,? (?:ale|nie)|wybacz,? (?:ale|ta|to|nie)|niestety,? (?:nie (?:mogę|jestem|potrafię)|muszę)"
    r"|\bi(?:'m| am) (?:sorry|unable|afraid|not (?:able|allowed|permitted))|\bi (?:can(?:'t|not| not)|won't|will not) (?:\w+ ){0,3}?(?:help|provide|answer|solve|assist|evaluate|judge|make|do|comply|complete|discuss|give|decide|rate|assess|respond)|\bi (?:must|have to|am forced to|need to) (?:\w+ ){0,2}?(?:decline|refuse)"
    r"|\b(?:as|being) an? (?:ai|artificial|language model|assistant)\b|not able to (?:assist|help|answer|solve|provide)|unable to (?:assist|help|answer|solve|provide|judge|evaluate|comply|fulfil)|\bi (?:decline|refuse)\b|must decline"
    r"|es tut mir leid|tut mir leid|leider (?:kann|muss|darf|bin)|ich (?:kann|darf|werde|möchte|muss) (?:\w+ ){0,6}?(?:nicht|ablehnen|keine)|als (?:ki|sprachmodell)"
    r"|(?:на жаль|вибач(?:те)?),? |не (?:можу|в змозі|буду|вмію) (?:\w+ ){0,4}?(?:допом|відпов|розв|оцін|викон|нада)|мушу відмовити|відмовляюс|як мовна модель"
    r"|(?:к сожалению|извините|простите),? |не могу (?:\w+ ){0,4}?(?:помочь|ответ|реш|оцен|выполн)|вынужден\w* отказ|отказываюсь|как языковая модель"
    r"|je (?:suis désolé|ne peux pas|refuse)|désolé,? |lo siento|no puedo (?:\w+ ){0,3}?(?:ayudar|responder|resolver)|mi dispiace|non posso (?:\w+ ){0,3}?(?:aiut|rispond|risolv)|omlouvám se|nemohu (?:\w+ ){0,3}?(?:pomoci|odpov)"
    r"|(?:sinto muito|desculpe|lamento),? (?:mas|não|eu)|não (?:posso|consigo|vou) (?:\w+ ){0,3}?(?:ajud|respond|resolv|fornec)|üzgünüm|özür dilerim|yardımcı olam|(?:cevap|yanıt)\w* verem|çözem(?:em|iyor)|cevaplayam"
    r"|het spijt me|ik kan (?:\w+ ){0,4}?niet|jag kan (?:\w+ ){0,2}?inte|jeg kan (?:\w+ ){0,2}?ikke|en voi (?:\w+ ){0,2}?(?:auttaa|vastata)|nu pot (?:\w+ ){0,3}?(?:ajut|răspun|rezolv)|sajnálom|nem tudok (?:\w+ ){0,3}?(?:segíteni|válaszolni)"
    r"|申し訳|(?:お答え|回答|お手伝い|対応|支援)(?:が|は|を|する(?:こと)?(?:が|は))?でき(?:ません|ない)|抱歉|对不起|無法(?:回答|提供|協助)|无法(?:回答|提供|协助|帮助|解答)|不能(?:回答|提供|帮助)|죄송|도와드릴 수 없|답변할 수 없|آسف|لا أستطيع|لا يمكنني",
    re.I,
)
#: Each phrase of REFUSALS has one of these in lower case; looking for them is cheaper.
STEMS = tuple(
    "nie mogę|nie jestem w stanie|nie potrafię|nie wolno mi|nie umiem|nie będę|nie podejmę|nie udzielę|nie odpowiem|nie rozwiążę|nie ocenię|odmówi|odmowi|odmawiam|wykracza poza to|jako model|jako asystent|jako sztuczna|jako ai"
    "|przykro mi|wybacz|niestety|i'm |i am |i can|i won't|i will not|decline|refuse|an ai|a ai|artificial|language model|assistant|able to|tut mir leid|leider|ich kann|ich darf|ich werde|ich möchte|ich muss|als ki|als sprachmodell"
    "|на жаль|вибач|не можу|не в змозі|не буду|не вмію|відмов|мовна модель|сожалению|извините|простите|не могу|отказ|языковая модель|je suis désolé|je ne peux|désolé|lo siento|no puedo|mi dispiace|non posso|omlouvám|nemohu"
    "|sinto muito|desculpe|lamento|não posso|não consigo|não vou|üzgün|özür dile|yardımcı ol|verem|çözem|çözüyor|cevaplayam|het spijt|ik kan|jag kan|jeg kan|en voi|nu pot|sajnálom|nem tudok"
    "|申し訳|でき|抱歉|对不起|無法|无法|不能|죄송|도와드릴|답변할|آسف|لا أستطيع|لا يمكنني".split("|")
)
SHORT_REFUSALS = re.compile(r"\bnie \w+(?:ę|em)\b|\bi (?:do not|don't|can(?:'t|not)|won't|will not|would not|wouldn't|would rather not|must|decline|refuse)\b|\bsorry\b|\bprzepraszam\b|\bniestety\b|\bwybacz|\bprzykro\b|\bunfortunately\b|\bleider\b|\bich \w+ (?:\w+ )*nicht\b|не (?:можу|буду|могу|стану)", re.I)
_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|[\n。！？]+")
#: What a sentence that does mathematics has.
_WORK = re.compile(r"[$\\=<>≤≥∈√]|\d")

#: Frequent words that mark a language and stand in none of the others.
STOPWORDS = {
    "pl": frozenset("nie się że jest dla oraz jeżeli jeśli gdy gdzie niech czyli przez wiedząc który która które tylko więc oznacza wynosi można mamy wtedy zatem stąd pokaż wyznacz oblicz wykaż ile jak po z w i od na czy tu już przy ale albo lub tego tej równego znika daje prowadzi zostaje zachodzi poza".split()),
    "en": frozenset("the of and that is we with by which this for from are such if then let be an it has have suppose prove find compute not here since using gives where because equals also can at on as".split()),
    "de": frozenset("der die das und ist nicht mit wir es sei ein eine einen dass daraus folgt also durch nun wird den dem von für auf sich gilt als erhalten".split()),
    "cs": frozenset("je že nebo pro jsou který která protože tedy platí nechť".split()),
    "fr": frozenset("le les des est une dans que pour donc avec soit alors nous par sur du".split()),
    "es": frozenset("el los las una es que por entonces donde como para sea con del".split()),
    "it": frozenset("il che di della per sono allora quindi dove poiché abbiamo una del con gli è si otteniamo perché".split()),
    "pt": frozenset("os uma que não então para com são portanto onde temos do da é seja pois".split()),
    "nl": frozenset("het een van dat dus voor met zijn wij geldt daarom waar niet en".split()),
    "tr": frozenset("ve bir bu için olarak ise olur değil çünkü ile eğer".split()),
}
_PL = re.compile("[ąćęłńśźż]")
_DE = re.compile("[äöüß]")
_FORMULA = re.compile(r"\$[^$]*\$|\\[a-zA-Z]+")
_BRACKET = re.compile(r"(\\[()\[\]])")
#: Names that markup puts between words.
_NAMES = frozenset("text textbf mathrm boxed begin end displaystyle quad".split())


def without_formulas(text: str) -> str:
    """The text without formulas of any length and commands; an opening bracket without its end is no formula.  Linear in the text."""
    if "\\(" in text or "\\[" in text:
        parts = _BRACKET.split(text)
        last = {p: i for i, p in enumerate(parts) if p in ("\\)", "\\]")}
        out, i = [], 0
        while i < len(parts):
            close = {"\\(": "\\)", "\\[": "\\]"}.get(parts[i])
            if close and last.get(close, -1) > i:
                i = parts.index(close, i)
                out.append(" ")
            else:
                out.append(parts[i])
            i += 1
        text = "".join(out)
    return _FORMULA.sub(" ", text)


def is_empty(text: str | None) -> bool:
    """Null, blank, placeholders or only a heading."""
    if text is None:
        return True
    if "<" not in text:
        others = 0
        for m in cleanup.WORD.finditer(text.lower()):
            others += m[0] not in PLACEHOLDERS and m[0] not in _NAMES
            if others > 12:
                return False  # too many words for any of them
    bare = _MARKUP.sub(" ", cleanup.fold(text)).strip().lower()
    found = cleanup.WORD.findall(bare)
    if not found:
        return not re.search(r"[∎□∅∞±√π]", bare)
    core = bare.strip(" .:;,!?()[]-–—…/\\'\"")
    if core in PLACEHOLDERS or core.replace(" ", "_") in PLACEHOLDERS or (len(found) > 1 and all(w in PLACEHOLDERS for w in found)):
        return True
    return len(found) <= 3 and found[0] in HEADINGS and (len(found) == 1 or bare.endswith((":", ":**")))


def is_refusal(text: str | None, question: str | None = None) -> bool:
    """A sentence declines the job, and no others do it: those with formulas or numbers, but for the question's own sentences, are no longer than those that decline."""
    if not text:
        return False
    bare = cleanup.fold(text).replace("’", "'")
    low = bare.lower()
    if not any(x in low for x in STEMS) and (_WORK.search(bare) or not SHORT_REFUSALS.search(bare)):
        return False
    sentences = [s for s in (" ".join(x.split()) for x in _SENTENCE.split(bare)) if s]
    declines = [s for s in sentences if REFUSALS.search(s)]
    works = [s for s in sentences if _WORK.search(s) and not REFUSALS.search(s)]
    if works and question:
        asked = set(cleanup.words(question))
        works = [s for s in works if sum(w not in asked for w in cleanup.words(s)) * 4 > len(cleanup.words(s))]
    if declines:
        return sum(map(len, works)) <= sum(map(len, declines))
    # weaker phrases, where nothing is worked out
    weak = sum(SHORT_REFUSALS.search(s) is not None for s in sentences)
    return not works and weak * 3 >= len(sentences) and not _WORK.search(bare) and len(bare.split()) > 3


@lru_cache(maxsize=10_000)
def is_refused(reason: str | None) -> bool:
    """As is_refusal, for reasons, of which few differ."""
    return is_refusal(reason)


def is_copy(question: str | None, solution: str) -> bool:
    """Only the question again, any number of times: a few words of dressing before it, nothing of substance behind it."""
    if not question:
        return False
    q = cleanup.words(question)
    folded = cleanup.fold(solution).lower()
    rare = sorted(set(q), key=lambda w: (-len(w), w))[:4]
    if sum(w in folded for w in rare) * 2 < len(rare):
        return False  # lacks the question's longest words
    s = cleanup.WORD.findall(folded)
    if len(q) < 3 or len(s) < 3:
        return bool(q) and len(s) % len(q) == 0 and q * (len(s) // len(q)) == s and bool(s)
    known = set(q)
    if sum(w not in known for w in s) > max(6, 0.15 * len(s)):
        return False
    return any(_covers(q, s, times) for times in {max(1, len(s) // len(q)), max(1, round(len(s) / len(q)))})


def _covers(q: list[str], s: list[str], times: int) -> bool:
    """Whether the words s are the words q, ``times`` times, with little more or less."""
    have, left = Counter({w: n * times for w, n in Counter(q).items()}), 0
    for w in s:
        if have[w] > 0:
            have[w] -= 1
        else:
            left += 1
    missing = sum(have.values())
    if left > max(6, 0.15 * len(s)) or missing > 0.2 * times * len(q):
        return False
    # where the question's words begin and end in the solution
    lead = next((k for k in range(min(9, len(s))) if s[k : k + 3] == q[:3]), 0)
    tail, known = 0, set(q)
    for w in reversed(s):
        if w in known:
            break
        tail += 1
    return tail <= 1 and lead + tail + 0.1 * len(s) >= left - 1 and not (tail and re.search(r"\d", s[-1]))


_UNIT_END = re.compile(r"(?:[.!?∎□■◻])[\"”'’)\]*_]*$|\\qed\s*\$?$|\\square\s*\$?$|(?:q\.?e\.?d|c\.?n\.?d|c\.?b\.?d\.?o|b\.?d\.?o)$", re.I)
_LIST_STUB = re.compile(r"(?:^|\n)[ \t]*(?:[-*•–]|\(?[a-z\d]{1,3}[.)]|(?:krok|step|punkt|część|case|schritt|крок)\s*\d*\s*[:.)]?)$", re.I)
_BROKEN_DOTS = re.compile(r"(?:\.\.\.|…|\[\.{2,3}\]?|\[…\]?)$")


def is_truncated(text: str) -> bool:
    """Stops in a word, formula, sentence or list."""
    t = cleanup.fold(text).rstrip()
    t = t.rstrip(t[-1]).rstrip() if t.endswith(("---", "***", "___")) else t
    if not t:
        return False
    end = t[-80:]  # the patterns of an end look no further back
    if "\n" in t and _LIST_STUB.search(t[max(t.rfind("\n"), 0) :]):
        return True
    if _BROKEN_DOTS.search(end):
        return True
    if t[-1] in ",;([{=+<>^_\\&|/-–—:":
        return len(t) > 1
    # unclosed formula, seen from the last line with a delimiter
    if _open_formula(t):
        return True
    if _UNIT_END.search(end):
        return False
    return t[-1].isalpha() and len(cleanup.WORD.findall(t)) > 4


_DISPLAY = re.compile(r"\\\\|\\\$|(\$\$?)|\\([\[\]])|\\(begin|end)\s*\{([^{}]*)\}|(\n)")


def _open_display(t: str) -> bool:
    """Whether a $$, \\[ or \\begin of any line is still open at the end."""
    if "$$" not in t and "\\[" not in t and "\\begin" not in t:
        return False
    inline = dollars = bracket = False
    environments: list[str] = []
    for m in _DISPLAY.finditer(t):
        sign, square, kind, name, line = m.groups()
        if sign == "$$" and not inline:
            dollars = not dollars
        elif sign == "$" and not dollars:
            inline = not inline
        elif square:
            bracket = square == "["
        elif kind == "begin":
            environments.append(name)
        elif kind == "end" and name in environments:
            del environments[len(environments) - 1 - environments[::-1].index(name) :]
        elif line:
            inline = False  # a single dollar holds for its line
    return dollars or bracket or bool(environments)


def _open_formula(t: str) -> bool:
    """Whether the text ends inside a formula; displays and environments may have begun on any line, the rest is seen from the last sentence.  An odd number of dollar signs alone tells nothing of the end: what follows the last one must not read as closed prose."""
    tail = t[max(t.rfind("\n"), t.rfind(". "), t.rfind("! "), t.rfind("? "), -1) + 1 :]
    if tail[-1:] in ".!?":
        return False
    if _open_display(t):
        return True
    if tail.replace("\\$", "").count("$") % 2:
        return True
    if any(tail.rfind(begin) > tail.rfind(end) for begin, end in (("\\(", "\\)"), ("\\[", "\\]"))):
        return True
    braces = re.sub(r"\\[{}]", "", tail)
    return braces.count("{") > braces.count("}")


#: Scripts by ranges of code points; the first two are of letters, the last three write words without blanks.
_SCRIPTS = (("cyrillic", "\u0400", "\u052f"), ("hebrew", "\u0590", "\u05ff"), ("arabic", "\u0600", "\u06ff"), ("devanagari", "\u0900", "\u097f"), ("kana", "\u3040", "\u30ff"), ("han", "\u4e00", "\u9fff"), ("hangul", "\uac00", "\ud7af"))


def _marks(word: str) -> tuple[str, ...]:
    if word[0] > "\u02ff":
        for name, first, last in _SCRIPTS:
            if first <= word[0] <= last:
                # Japanese mixes two scripts; words without blanks between them count by their length
                return ("han" if name == "kana" else name,) * (1 + len(word) // 4 if name in ("kana", "han") else 1)
    if _PL.search(word):
        return ("pl",)
    if _DE.search(word):
        return ("de",)
    return tuple(k for k, stop in STOPWORDS.items() if word in stop)


#: Marks of words met so far, for speed; started anew when full.
_SEEN: dict[str, tuple[str, ...]] = {}


#: Words outside formulas from which on a text without any mark of the question's language is in another, known or not.
UNMARKED = 20


def languages(text: str) -> Counter:
    """Evidence for each language: words that mark it; under None the number of words of three letters and more."""
    if len(_SEEN) > 200_000:
        _SEEN.clear()
    found = []
    words = cleanup.LETTERS.findall(without_formulas(cleanup.fold(text).lower()))
    for w in words:
        marks = _SEEN.get(w)
        if marks is None:
            marks = _SEEN[w] = _marks(w)
        if marks:
            found += marks
    score = Counter(found)
    score[None] = sum(len(w) > 2 for w in words)
    return score


def language_of(score: Counter) -> str | None:
    top = Counter({k: n for k, n in score.items() if k}).most_common(2)
    if not top or top[0][1] < 3 or (len(top) > 1 and top[1][1] * 2 > top[0][1]):
        return None
    return top[0][0]


def is_other_language(question: str | None, solution: str) -> bool:
    """The whole solution in another language than the question."""
    if not question:
        return False
    ask, reply = languages(question), languages(solution)
    a, b = language_of(ask), language_of(reply)
    if a is None:
        return False
    return (b is not None and a != b and reply[a] * 6 <= reply[b]) or (b is None and reply[a] == 0 and reply[None] >= UNMARKED)


def defects_of(question: str | None, solution: str | None, reason: str | None) -> list[str]:
    """Every defect whose rule fires, in the order of ORDER."""
    if is_empty(solution):
        return ["empty", "refusal"] if is_refused(reason) else ["empty"]
    out = []
    copied = is_copy(question, solution)
    if is_refused(reason) or (is_refusal(solution, question) and not copied):
        out.append("refusal")
    if copied:
        out.append("copy")
    if is_truncated(solution):
        out.append("truncated")
    if is_other_language(question, solution):
        out.append("language")
    return out


def pair_defects(df: DataFrame, question_col: str = "question", solution_col: str = "solution", reason_col: str = "filter_reason", out_col: str = "defects") -> DataFrame:
    """The rows with ``out_col`` (array<string>, empty for sound pairs), the pair's first defect first.

    A null or empty solution is ``empty``; null questions and reasons trigger nothing; texts are
    judged whole; repeated rows stay; other columns pass through and one named ``out_col`` is replaced.
    """
    keep = [c for c in df.columns if c != out_col]
    given = df.select(*keep, *[F.col(c).alias(f"pair_arg{i}") for i, c in enumerate((question_col, solution_col, reason_col))])
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out_col, T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [defects_of(*row) for row in zip(*[c.to_pylist() for c in b.columns[len(keep) :]], strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(out, pa.list_(pa.string()))], names=[*keep, out_col])

    return given.mapInArrow(run, schema)

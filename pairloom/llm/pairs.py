"""Problem 4: question and answer pairs that are of no use for training.

Ordered rules, each of which emits its defect when it fires:

1. ``empty``: the answer is null, shows nothing, or is a stand-in for a missing answer.
2. ``copied_question``: it is the question again, with at most small alterations.
3. ``refusal``: a sentence of it (outside quotation marks) declines to answer.
4. ``truncated``: an unclosed delimiter, an abrupt ending, or an unfinished sentence or list.
5. ``wrong_language``: another script or language than the question's, unless asked for.

Texts are brought to one spelling (problem 1) before the rules look at them. A small
model of which language a word speaks for is fitted on the ``rows`` rows of lowest
hash (a documented bound). Which last words are broken off is decided by word counts
over all rows. Rows themselves are independent and are not shuffled, unless the
table of broken words outgrows a broadcast.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.lookalikes import canonical_columns
from pairloom.llm.sampling import lowest_hash_rows
from pairloom.storage import materialize, spread

DEFECTS = ("empty", "copied_question", "refusal", "truncated", "wrong_language")

# Stand-ins for a missing answer, without case, spaces and brackets.
STAND_INS = frozenset(
    "n/a na n.a n.a. null none nil nan empty blank missing unanswered undefined unknown tbd todo void noanswer noanswergiven noanswerprovided "
    "answer noresponse notavailable notapplicable notanswered nodata keineantwort sinrespuesta sansréponse pasderéponse aucuneréponse khôngcó "
    "khôngcâutrảlời khôngcócâutrảlời chưacócâutrảlời chưatrảlời trống нетответа безответа 無回答 回答なし 未回答 なし".split()
)

_STAND_IN_PHRASE = re.compile(
    r"(?:no|without(?: an?)?) (?:caption|answer|response|description|text|label|comment|data|value|information|content)(?: (?:was |is |has been )?(?:given|provided|available|found|supplied|recorded|entered|yet))?"
    r"|(?:answer|caption|response|text)(?: is)? (?:missing|not (?:given|provided|available|found|recorded)|pending|unavailable)|not (?:answered|available|provided|given|applicable|recorded)|to be (?:added|answered|filled in|determined)"
    r"|(?:sin|ninguna) (?:respuesta|descripción)|(?:pas de|sans|aucune) (?:réponse|légende|description)|keine (?:antwort|beschreibung|angabe)(?: vorhanden)?|(?:không có|chưa có|thiếu) (?:câu trả lời|chú thích|mô tả|đáp án)|(?:нет|без) (?:ответа|подписи|описания)"
)

# Words that only one of the languages uses often.
MARK_WORDS = {
    "en": "the is are what which where who how does would can you tell me whether name two count and of in to there it that this with an why".split(),
    "vi": "là có gì ở đâu trong cái con chiếc người màu hãy tả cảnh vật vì sao lại đứng hay nào kể tên hai thứ bức ảnh được và không đang".split(),
    "fr": "le les est une des du que où quelle voit pourquoi combien personnes fait dans sur avec il elle et y sous près".split(),
    "es": "el los las qué dónde está por cuántas hay hace una del es y en se ve color junto también muy".split(),
    "de": "der die das ist was welche farbe wo befindet sich macht warum bleibt wie viele leute stehen man und dem den im am sieht".split(),
}
ASKED = [
    ("vi", r"vietnamese|tiếng việt|vietnamesisch|vietnamien|vietnamita|вьетнам|ベトナム"),
    ("en", r"english|tiếng anh|englisch|anglais|inglés|inglesa|англий|英語"),
    ("fr", r"french|tiếng pháp|französisch|français|francés|francesa|француз|フランス"),
    ("es", r"spanish|tiếng tây ban nha|spanisch|espagnol|español|испанск|スペイン"),
    ("de", r"german|tiếng đức|\bdeutsch|allemand|alemán|alemana|немецк|ドイツ"),
    ("ru", r"russian|tiếng nga|russisch|russe|rus[oa]\b|русск|по-русски|ロシア"),
    ("ja", r"japanese|tiếng nhật|japanisch|japonais|japonés|japonesa|японск|日本語"),
]

# Ways to decline, by language. Each is searched in one sentence without its quotations.
REFUSALS = [
    # English
    r"\bI(?:'m| am)? ?(?:can ?not|can't|could ?not|couldn't|will not|won't|am unable|unable|am not able|not able|won't be able|will not be able|am not permitted|am not allowed|not allowed|not permitted)(?: to| be able to)? (?:answer|provide|assist|help|comply|discuss|describe|identify|comment|respond|fulfil|fulfill|share|do that|analyse|analyze|offer|talk|engage|continue|give|support|say|speak|complete|process)\b",
    r"\bI (?:must|have to|need to|am going to|will have to|would have to) (?:decline|refuse|pass|leave this|leave that|turn (?:this|that) down)",
    r"\bI (?:decline|refuse) to (?:answer|describe|comment|discuss|say|respond)",
    r"\b(?:against|outside|violates?|contrary to|beyond) (?:of )?(?:my|our|the) (?:guidelines|policy|policies|rules|principles|scope)",
    r"\bI(?:'m| am) only able to (?:handle|answer|help)|\bI can only (?:help|handle|answer|assist)",
    r"\bI(?:'d| would) (?:rather|prefer) not\b|\bsomething I(?:'d| would) rather not",
    r"\bI (?:do not|don't) have (?:the )?permission\b|\bnot something I (?:can|could|may|am able to) (?:do|answer|discuss)",
    r"\b(?:policy|rules|guidelines)\b.{0,25}\b(?:does not|do not|don't|doesn't|will not|won't) (?:let|allow|permit) me",
    r"\b(?:would be|is|be) (?:inappropriate|improper|wrong|not appropriate) for me to\b|\bcan(?:not|'t| not)? be given by me\b|\bno (?:description|answer|comment)\b.{0,60}\bby me\b",
    r"\bnot in a position to (?:answer|help|say|comment|describe)",
    # Vietnamese
    r"tôi (?:rất tiếc )?không (?:thể|được phép|tiện|có quyền|muốn) (?:trả lời|hỗ trợ|giúp|mô tả|phân tích|bình luận|nói|nhận xét|cung cấp|thực hiện|đáp ứng|đưa ra|xác định|thảo luận)",
    r"tôi (?:buộc phải|phải|xin|xin phép|xin được) từ chối|xin (?:phép )?(?:được )?từ chối",
    r"ngoài (?:phạm vi|khả năng)(?: hỗ trợ)? của tôi|tôi chỉ (?:có thể )?(?:hỗ trợ|trả lời) (?:được )?những",
    r"không phù hợp với (?:quy định|chính sách|nguyên tắc)|trái với (?:quy định|chính sách|nguyên tắc)",
    # Spanish
    r"no (?:puedo|podré|podría|me es posible|soy capaz de) (?:ayudar|responder|contestar|describir|comentar|hablar|decir|identificar|analizar|proporcionar|ofrecer|atender|cumplir)",
    r"(?:debo|tengo que|he de) (?:rechazar|declinar|negarme)|me niego a",
    r"no (?:me )?está permitido|no me permiten?|no tengo permiso|no me corresponde|prefiero no (?:decir|opinar|hablar|comentar|responder|contestar)|fuera de mi (?:alcance|ámbito)|contra mis (?:normas|reglas|directrices)|solo puedo (?:ayudar|atender|responder)",
    # French
    r"je ne (?:peux|pourrai|saurais|suis) (?:pas )?(?:pas )?(?:vous )?(?:répondre|aider|décrire|commenter|identifier|parler|traiter|fournir|en mesure|autorisé|habilité|dire)",
    r"je (?:dois|me dois de|préfère|suis contraint de|suis obligé de) (?:refuser|décliner|ne (?:rien|pas))|je (?:refuse|décline)\b",
    r"il ne m'est pas (?:permis|possible)|ne relève pas de mes|(?:contraire|contre) (?:à )?mes (?:règles|principes|consignes)|hors de mon (?:domaine|champ)|je (?:ne )?peux seulement (?:aider|traiter)|ne m'appartient pas",
    # German
    r"(?:ich )?(?:kann|darf|möchte|werde|will|muss|könnte) (?:ich )?(?:dazu |leider |mich |hier |dieses? |diese[rnm]? |die |das |den |ihnen |dabei |hierzu |zu )*(?:\w+ ){0,4}(?:nicht|nichts|keine\w*) ?(?:\w+ ){0,4}(?:beantworten|beschreiben|äußern|helfen|sagen|kommentieren|antworten|identifizieren|geben|erfüllen|besprechen|bearbeiten|erkennen lassen)",
    r"muss ich (?:leider )?(?:ablehnen|verweigern|zurückweisen)|ich muss .{0,50}\b(?:ablehnen|verweigern)|lehne ich ab|nicht (?:gestattet|erlaubt)\b|gegen meine (?:richtlinien|regeln|vorgaben)|nicht (?:meine|meines) (?:aufgabe|aufgaben|amtes)|steht mir nicht zu|gehört nicht zu meinen",
    # Russian
    r"(?:я )?(?:не могу|не смогу|не вправе|не буду) (?:\w+ )?(?:ответить|отвечать|помочь|описать|описывать|комментировать|обсуждать|сказать|говорить|назвать|определить|выполнить|анализировать)",
    r"мне не (?:разрешено|позволено|следует|дозволено|положено)|(?:вынужден|вынуждена|должен|должна|приходится) (?:отказ|отклон)|предпочёл бы не|предпочту не|предпочитаю не|против моих правил|вне моей компетенции|не входит в мои|(?:отказываюсь|воздержусь)",
    # Japanese
    r"お答え(?:は|を)?(?:でき|いたしかね|致しかね|しかね|差し控え|控え)|(?:回答|説明|コメント|お手伝い|描写|ご案内|ご対応|対応|判断|特定)(?:は|を|することは|することが|が|に)?(?:差し控え|控え|でき(?:ません|かね)|いたしかね|致しかね|しかね|許可されて|お断り|辞退)|お断り(?:し|いた|させ)|お手伝いできません|応じられません|許可されていません|申し上げられません|お話しできません|答えられません",
]


def needed(pattern: str, most: int = 64) -> frozenset[str]:
    """Literals of which every match of ``pattern`` holds at least one; the empty set if there are none to name.

    Read off the parsed pattern, so that looking for them first loses no match.
    """
    best: list[frozenset[str]] = []

    def put(words_: set[str]) -> None:
        if words_ and all(words_):
            best.append(frozenset(words_))

    def spelled(items) -> set[str] | None:
        """All texts that the items match, if they are few and plain."""
        have = {""}
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                more = {chr(arg)}
            elif name == "AT":
                more = {""}
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                more = {chr(x) for _, x in arg}
            elif name == "SUBPATTERN":
                more = spelled(arg[-1])
            elif name == "BRANCH":
                parts = [spelled(x) for x in arg[1]]
                more = None if None in parts else set().union(*parts)
            elif name == "MAX_REPEAT" and arg[1] == 1:
                more = spelled(arg[2])
                more = None if more is None else more | ({""} if arg[0] == 0 else set())
            else:
                more = None
            if more is None or len(have) * len(more) > most:
                return None
            have = {x + y for x in have for y in more}
        return have

    def walk(items) -> None:
        run = {""}
        for item in items:
            more = spelled([item])
            if more is not None and len(run) * len(more) <= most:
                run = {x + y for x in run for y in more}
                continue
            put(run)
            run = {""} if more is None else more
            if more is None and str(item[0]) == "SUBPATTERN":
                walk(item[1][-1])
            elif more is None and str(item[0]) == "BRANCH":
                parts = [needed_of(x) for x in item[1][1]]
                if all(parts):
                    put(set().union(*parts))
        put(run)

    def needed_of(items) -> frozenset[str]:
        kept, best[:] = list(best), []
        walk(items)
        found = max(best, key=lambda x: (min(map(len, x)), -len(x)), default=frozenset())
        best[:] = kept
        return found

    return needed_of(re._parser.parse(pattern))


_REFUSAL = [re.compile(r.lower()) for r in REFUSALS]


def _by_literal() -> dict[str, tuple[int, ...]]:
    """Literal -> the patterns that may match where it occurs; "" for those that need none."""
    out: dict[str, set[int]] = {}
    for i, r in enumerate(REFUSALS):
        for w in needed(r.lower()) or {""}:
            out.setdefault(w, set()).add(i)
    return {w: tuple(sorted(v)) for w, v in out.items()}


_LITERALS = _by_literal()


def _automaton():
    try:
        import ahocorasick
    except ImportError:
        return None
    found = ahocorasick.Automaton()
    for w, which in _LITERALS.items():
        if w:
            found.add_word(w, which)
    found.make_automaton()
    return found


_FOUND = _automaton()


def _candidates(low: str) -> set[int]:
    """Patterns that may match in a text of lower case."""
    out = set(_LITERALS.get("", ()))
    if _FOUND is not None:
        for _, which in _FOUND.iter(low):
            out.update(which)
    else:
        for w, which in _LITERALS.items():
            if w in low:
                out.update(which)
    return out


_QUOTED = re.compile(r'"[^"]*"|“[^”]*”|«[^»]*»|„[^“”]*[“”]|「[^」]*」|『[^』]*』')
_SENTENCE_END = re.compile(r"(?<=[.!?。！？])\s+|\n+|(?<=[。！？])")

# Words that no whole sentence or phrase ends with.
DANGLING = frozenset(
    "a an the and or of with to at in on by for from into because while its his her their next beside near which that than as is are was were "
    "và hoặc của với ở nằm là một những các vì nhưng mà để từ tại cho bằng như thì "
    "y o de del la el los las un una con en por para que porque su junto "
    "et ou du des le les une avec dans sur pour parce car sous à près dont son sa "
    "und oder der die das den dem ein eine einer einem einen mit zu auf im am weil neben von vor unter hinter seiner seinem ihrer ihrem "
    "и или с на у за под в к от до потому что рядом возле перед для о".split()
)
_CLOSERS = "'\"”’»)]」』"
_LIST_LINES = re.compile(r"\n\s*(?:\(?\d{1,3}[.)]|[-*•])\s")
_LIST_MARK = re.compile(r"\(?\d{1,3}[.)]|[-*•]")
_LABEL = re.compile(r"\W*(?:question|q|câu(?: hỏi)?|frage|pregunta|вопрос|質問)\s*[:：]", re.I)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_PAIRS = {")": "(", "]": "[", "}": "{", "」": "「", "』": "『", "»": "«", "”": "“"}
_UNSEEN = regex.compile(r"[\p{Z}\p{C}\s]+")
_ALNUM = regex.compile(r"[\p{L}\p{N}]")
_SYMBOL = regex.compile(r"[\p{So}\p{Sc}\p{Sm}]")
_OPENING = re.compile("[(\\[{「『«“\"]")
_SHOWN = regex.compile(r"[^\p{Z}\p{C}\s\p{M}]")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


question_words = lru_cache(maxsize=1 << 17)(words)


def is_empty(answer: str | None) -> bool:
    """Null, nothing visible, punctuation only, or a stand-in."""
    if answer is None or not _SHOWN.search(answer):
        return True
    core = _UNSEEN.sub(" ", answer).strip().lower()
    if not _ALNUM.search(core):
        return not _SYMBOL.search(core) or core == "<>"
    core = core.strip("<>[](){}\"'*_-–—.!…:;/\\ ")
    return core.replace(" ", "") in STAND_INS or _STAND_IN_PHRASE.fullmatch(core) is not None


def is_copy(question: str, answer: str, q: list[str] | None = None, a: list[str] | None = None) -> bool:
    """The answer's words are the question's in their order, but for few; nothing else is added."""
    q, a = q or question_words(question), a or words(answer)
    if not a or not q or (len(a) > 2 * len(q) + 3) or (len(q) > 2 * len(a) + 3 and len(q) > 3):
        return False
    if (label := _LABEL.match(answer)) is not None:
        a = words(answer[label.end() :]) or a
    if len(q) == 1 and len(a) == 1:  # scripts without spaces
        return similar(q[0], a[0]) >= 0.8 and len(q[0]) > 5 or q == a
    if len(q) < 2 or len(a) < 2:
        return "".join(q) == "".join(a) != ""
    if len(q) <= 3 and any(len(w) > 8 and _JA.match(w) for w in q):
        return similar("".join(q), "".join(a)) >= 0.8
    short = min(len(q), len(a))
    if short < 0.7 * max(len(q), len(a)):
        return False
    if len(set(q) & set(a)) < 0.6 * len(set(q)):
        return False
    same = common_subsequence(q, a)
    return same >= len(a) - max(1, len(a) // 8) and same >= len(q) - max(1, len(q) // 5)


def without_accents(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.replace("đ", "d")) if not unicodedata.combining(c))


def common_subsequence(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            up = row[j]
            row[j] = left + 1 if x == y else max(up, row[j - 1])
            left = up
    return row[-1]


def similar(a: str, b: str) -> float:
    return 2 * common_subsequence(list(a), list(b)) / max(1, len(a) + len(b))


def is_refusal(answer: str) -> bool:
    """Some sentence, without what it quotes, declines."""
    low = answer.lower().replace("’", "'")
    if _OPENING.search(low):
        low = _QUOTED.sub(" ", low)
    which = _candidates(low)
    return bool(which) and any(_REFUSAL[i].search(x) for x in _SENTENCE_END.split(low) for i in which)


def unclosed(text: str) -> bool:
    """A bracket that is opened and not closed, or an odd number of straight quotation marks."""
    if not _OPENING.search(text):
        return False
    open_: list[str] = []
    for ch in text:
        if ch in "([{「『«“":
            open_.append(ch)
        elif ch in _PAIRS and open_ and open_[-1] == _PAIRS[ch]:
            open_.pop()
    return bool(open_) or text.count('"') % 2 == 1


@dataclass(frozen=True)
class PairModel:
    """``word_logs``: word -> log probabilities by language, in the order of ``languages``;
    ``foreign``: by language, the words that speak against it and how much at most."""

    languages: tuple[str, ...]
    word_logs: dict[str, tuple[float, ...]]
    foreign: dict[str, dict[str, float]]

    def language(self, text: str) -> tuple[str | None, float]:
        """(most likely language, margin over another in natural logs); None without words."""
        script = by_script(text)
        if script:
            return script, 99.0
        votes = [0.0] * len(self.languages)
        seen = 0
        for w in set(words(text)):
            logs = self.word_logs.get(w) if len(w) > 1 else None
            if logs:
                seen += 1
                for i, v in enumerate(logs):
                    votes[i] += v
        if not seen:
            return None, 0.0
        order = sorted(range(len(votes)), key=lambda i: -votes[i])
        return self.languages[order[0]], votes[order[0]] - votes[order[1]]

    def score(self, ws: set[str], language: str) -> float:
        """Log odds of the best other language against ``language`` for a set of words; 0 or less if none is better."""
        against = self.foreign.get(language)
        if against is None or sum(against[w] for w in ws & against.keys()) < 1:
            return 0.0  # even if all these words spoke for one language
        i = self.languages.index(language)
        votes = [0.0] * len(self.languages)
        for w in ws:  # a word said over and over speaks once
            logs = self.word_logs.get(w) if len(w) > 1 else None
            if logs:
                for j, v in enumerate(logs):
                    votes[j] += v - logs[i]
        return max(votes)


_JA = re.compile(r"[぀-ヿ㐀-鿿]")
_RU = re.compile(r"[Ѐ-ӿ]")
_LAT = re.compile(r"[A-Za-zÀ-ỹ]")


def by_script(text: str) -> str | None:
    """'ja' or 'ru' if that script has most letters."""
    if text.isascii():
        return None
    ja, ru = len(_JA.findall(text)), len(_RU.findall(text))
    if not ja and not ru:
        return None
    lat = len(_LAT.findall(text))
    return "ja" if ja >= ru and 2 * ja > lat else "ru" if 2 * ru > lat else None


@lru_cache(maxsize=1 << 17)
def mark_language(text: str) -> str | None:
    """Language of a text by the fixed mark words; None if they do not decide."""
    script = by_script(text)
    if script:
        return script
    ws = words(text)
    counts = sorted(((sum(w in m for w in ws), lang) for lang, m in _MARKS.items()), reverse=True)
    return counts[0][1] if counts[0][0] >= 2 and counts[0][0] > counts[1][0] else None


_MARKS = {k: frozenset(v) for k, v in MARK_WORDS.items()}


def _taught(question: str | None, answer: str | None) -> Iterator[tuple[str, str]]:
    """(language, text) of the texts of a row that teach a language."""
    lang = mark_language(question) if question else None
    own = mark_language(answer) if answer else None
    if lang in _MARKS:
        yield lang, question
        # A longer answer in evidently another language teaches that language.
        if answer and own in (None, lang) and not any(re.search(p, question.lower()) for _, p in ASKED):
            yield lang, answer
    if answer and own in _MARKS and own != lang:
        yield own, answer


def fit_pairs(df: DataFrame, id_col: str, question: str, answer: str, rows: int = 20_000, most_words: int = 200_000, seed: int = 11) -> PairModel:
    """Language model from at most ``rows`` rows, those of lowest hash, whatever the size of the table.

    Words are counted on the executors; the ``most_words`` most frequent ones reach
    the driver, no text does. ``df`` should hold texts in one spelling.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    sample = lowest_hash_rows(df.select(F.col(id_col).alias("i"), F.col(question).alias("q"), F.col(answer).alias("a")), rows, seed, F.col("i")).repartition(cores)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for pdf in batches:
            for q, a in zip(pdf["q"], pdf["a"]):
                for lang, text in _taught(q, a):
                    found.update((lang, w) for w in words(text))
        yield pd.DataFrame([(k, w, n) for (k, w), n in found.items()], columns=["lang", "word", "n"])

    counted = sample.mapInPandas(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts: dict[str, Counter] = {lang: Counter() for lang in MARK_WORDS}
    for r in counted.orderBy(F.desc("n"), "lang", "word").limit(most_words).collect():
        counts[r.lang][r.word] = r.n
    for w, c in list(counts["vi"].items()):
        bare = without_accents(w)
        if bare != w:  # Vietnamese typed without its accents is Vietnamese
            counts["vi"][bare] += max(1, c // 8)
    languages = tuple(counts)
    totals = {k: sum(c.values()) or 1 for k, c in counts.items()}
    logs = {}
    for w in sorted(set().union(*counts.values())):
        # Rates with a floor: one stray occurrence in a large language is noise.
        logs[w] = tuple(math.log(max(counts[k][w] / totals[k], 2e-5) + 1e-6) for k in languages)
    foreign = {k: {w: max(v) - v[i] for w, v in logs.items() if len(w) > 1 and max(v) > v[i]} for i, k in enumerate(languages)}
    return PairModel(languages, logs, foreign)


# The same in the JVM's regular expressions.
_WORD_JVM = r"\p{L}+(?:['’]\p{L}+)?"
_STOPPED_JVM = r"[.!?。！？]['\"”’»)\]」』\s]*$"


def last_word(answer: Column) -> Column:
    """The last word of an answer that no sign ends; null for others."""
    return F.when(~answer.rlike(_STOPPED_JVM), F.try_element_at(F.regexp_extract_all(F.lower(answer), F.lit(_WORD_JVM), F.lit(0)), F.lit(-1)))


def fragments(df: DataFrame, question: str, answer: str, least: int = 3, times: int = 10, longest: int = 64) -> DataFrame:
    """(fragment): last words of unstopped answers that are broken off inside a word.

    Words are counted over all rows, apart where they end an unstopped answer and
    where they stand elsewhere. A fragment stands elsewhere fewer than ``least`` times
    or less often than as a last word, and begins a longer word that stands elsewhere
    ``least`` times or more and ``times`` as often; both grow with the number of
    rows, so pieces that stray into other texts do not become words. Runs of more than
    ``longest`` letters are no entries of the word list. Counts are summed in the
    tasks before the one shuffle.
    """
    found = lambda c: F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(_WORD_JVM), F.lit(0))
    parts = df.select(found(question).alias("q"), found(answer).alias("a"), F.coalesce(F.col(answer).rlike(_STOPPED_JVM), F.lit(True)).alias("stopped"))
    ends = ~F.col("stopped") & (F.size("a") > 0)
    each = parts.select(F.explode(F.col("q")).alias("w"), F.lit(0).alias("last")).unionByName(parts.select(F.posexplode("a").alias("at", "w"), (ends & (F.col("at") == F.size("a") - 1)).cast("int").alias("last")).select("w", "last"))
    each = each.where(F.length("w") <= longest).select("w", "last", (1 - F.col("last")).alias("inner"))
    counts = materialize(each.groupBy("w").agg(F.sum("inner").alias("inner"), F.sum("last").alias("last")), "word-counts")
    known = counts.where((F.col("inner") >= least) & (F.length("w") > 1))
    begins = F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda n: F.substring(F.col("w"), F.lit(1), n))).alias("fragment")
    longer = known.select(begins, "inner").groupBy("fragment").agg(F.max("inner").alias("longer"))
    ends_ = counts.where((F.col("last") > 0) & ((F.col("inner") < least) | (F.col("inner") < F.col("last")))).select(F.col("w").alias("fragment"), "inner")
    return materialize(ends_.join(longer, "fragment").where(F.col("longer") >= times * F.col("inner")).select("fragment"), "fragments")


def is_stopped(text: str) -> bool:
    """Ends the text with a sign that ends a sentence, whatever closes after it?"""
    while (bare := text.rstrip().rstrip(_CLOSERS)) != text:
        text = bare
    return text.endswith((".", "!", "?", "。", "！", "？"))


def ends_with_list_mark(text: str) -> bool:
    """Is the last piece the mark of a list's next item, which is missing?

    A bullet is one; a number is one after the end of a sentence or line, or if the text has an earlier mark.
    """
    pieces = text.split()
    if len(pieces) < 2 or _LIST_MARK.fullmatch(pieces[-1]) is None:
        return False
    return pieces[-1] in "-*•" or text[: -len(pieces[-1])].rstrip(" \t")[-1:] in "\n.!?:;。！？" or any(_LIST_MARK.fullmatch(x) for x in pieces[:-1])


def is_truncated(answer: str, cut: bool = False) -> bool:
    """An unclosed delimiter, an abrupt ending or an unfinished sentence or list.

    Whole phrases and captions without a full stop are not. ``cut``: the last word
    is known to be a fragment.
    """
    text = answer.strip()
    if text.endswith(("…", "...")):
        return True
    if ends_with_list_mark(text):
        return True
    stopped = is_stopped(text)
    if stopped and not _OPENING.search(text):
        return False
    bare = text.strip("\"'“”« »").strip()
    if unclosed(text) and unclosed(bare):
        return True
    if stopped:
        return False
    ws = words(text)
    if not ws:
        return False
    if bare.endswith((",", ";", ":", "-", "–", "—", "、")):
        return True
    if (len(ws) > 2 and ws[-1] in DANGLING) or (len(ws) > 1 and cut):
        return True
    if re.search(r"[.!?](?:['\"”])?\s+\S|[。！？]\S", bare) or _LIST_LINES.search(bare):  # former sentences are complete, the last is not
        return True
    if len(re.findall(r"[,;、]", bare)) >= 2:
        return True
    return len(ws) > 4 and _CLAUSE.search(bare.lower()) is not None and re.match(r"(?:an?|the|el|la|los|las|le|les|un|une|una|der|die|das|ein|eine)\s+\S+(?:\s+\S+)?$", bare.lower()) is None


_CLAUSE = regex.compile(
    r"^(?:yes|no|there|it|i|you|we|they|he|she|this|that|có|không|đó|ta|nó|vermutlich|es|man|hay|parece|sí|se|il|elle|on|oui|non|que|там|похоже|да|нет)\b"
    r"|\b(?:is|are|was|has|have|shows|looks|stands|stays|keeps|gives|would|can|could)\b|\b(?:ist|sind|befindet|liegen|steht|stehen|wirkt|bleibt|faltet|macht)\b"
    r"|\b(?:est|sont|trouve|voit|semble|vient)\b|\b(?:está|están|es|parece|llega)\b|\b(?:là|được|nằm)\b|\S đang\b|\b(?:находится|видно|виден|стоят|падает)\b"
)


def is_wrong_language(question: str, answer: str, model: PairModel, margin: float = 3.0, a: list[str] | None = None) -> bool:
    """The answer speaks another language than the question, which did not ask for it.

    Quoted words, digits and single letters say nothing.
    """
    body = answer if answer.lstrip().startswith(('"', "“", "«", ">")) or not _OPENING.search(answer) else _QUOTED.sub(" ", answer)
    lang = question_language(question, model)
    if lang is None:
        return False
    own = None if body.isascii() else by_script(body)
    if own is None:
        ws = set(a if a is not None and body is answer else words(body))
        if lang in ("ja", "ru"):
            if len(_LAT.findall(body)) < 3:
                return False
            own = mark_language(body) or model.language(body)[0] or "en"
        elif not any(len(w) > 2 for w in ws) or model.score(ws, lang) < margin:
            return False  # units and the like belong to no language
        else:
            own = model.language(body)[0]
    if own is None or own == lang:
        return False
    low = question.lower()
    return not any(k == own and re.search(p, low) for k, p in ASKED)


def question_language(question: str, model: PairModel) -> str | None:
    return mark_language(question) or model.language(question)[0]


def defects(question: str | None, answer: str | None, model: PairModel, cut: bool = False) -> list[str]:
    """Every triggered defect, in the order of :data:`DEFECTS`, of texts in one spelling.

    An empty answer has nothing that another rule could look at. A missing
    question is no defect and switches the rules off that need one.
    """
    if is_empty(answer):
        return ["empty"]
    aw = words(answer)
    asked = question is not None and _SHOWN.search(question) is not None
    out = []
    if asked and is_copy(question, answer, None, aw):
        out.append("copied_question")
    if is_refusal(answer):
        out.append("refusal")
    if is_truncated(answer, cut):
        out.append("truncated")
    if asked and is_wrong_language(question, answer, model, a=aw):
        out.append("wrong_language")
    return out


def pair_defects(df: DataFrame, id_col: str = "row_index", question: str = "question", answer: str = "answer", model: PairModel | None = None) -> DataFrame:
    """(id, defects array) of each row with a defect; see :func:`defects`.

    Repeated rows give a row each; other columns are not read. An empty table
    gives an empty result. Last words are looked up in the table of fragments by a
    join, whose side Spark broadcasts only while its files are small.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = materialize(canonical_columns(df.select(F.col(id_col).alias("i"), F.col(question).alias("q"), F.col(answer).alias("a")), ("q", "a")), "spelled-pairs")
    model = model or fit_pairs(rows, "i", "q", "a")
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by its number of words
    cut = fragments(rows, "q", "a").select("fragment", F.lit(True).alias("cut"))
    looked = spread(rows).withColumn("fragment", last_word(F.col("a"))).join(cut, "fragment", "left").select("i", "q", "a", F.coalesce("cut", F.lit(False)).alias("cut"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            found = [defects(q, a, m, c) for q, a, c in zip(pdf["q"], pdf["a"], pdf["cut"])]
            keep = [bool(f) for f in found]
            out = pdf.loc[keep, ["i"]].rename(columns={"i": id_col})
            yield out.assign(defects=pd.Series([f for f in found if f], index=out.index, dtype=object))

    return looked.mapInPandas(run, f"`{id_col}` {kind}, defects array<string>")

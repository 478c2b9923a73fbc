"""Broken prompt and response pairs.

Each answer is read by a suffix automaton over the words of its question (how much of the answer is copied), by
automata of refusal phrases, by a stack of delimiters (answers that break off) and by votes of stop words and scripts
(answers in another language). A pair has at most one defect, tried in the order ``empty``, ``other_language``,
``copies_question``, ``refusal``, ``truncated``.

Null answers are ``empty``; null questions and instructions count as empty texts (no language to differ from, nothing
to copy). Repeated rows give the same defect; callers drop them by key.
"""

from __future__ import annotations

import re
from itertools import chain

import ahocorasick
from pyspark.sql import DataFrame

from siltstone.llm.common import WORD, map_rows

# What stands in for an answer, letters and digits only, lower case.
STAND_INS = frozenset(
    """na none null nil nan empty noanswer noresponse answer answers a response reply tbd tba todo blank unknown undefined placeholder
    missing notavailable notapplicable keineantwort antwort ka keine leer réponse pasderéponse aucune sansréponse aucuneréponse vide
    respuesta sinrespuesta ninguna nohayrespuesta vacío vacio nd""".split()
)
# Function words by language, for votes. Words of several languages are in each of them.
STOP_WORDS = {
    "en": """the of and to in is was were are be been has have had it its that this these those with for from by at on as an a or not but
        they he she his her their we you i when while because since although after before which who what how why where than then more
        each every one all any into over under near no yes if will would can cannot could should must so do does did""",
    "de": """der die das des dem den ein eine einer eines einem einen und oder aber nicht ist sind war waren wird werden wurde wurden
        hat haben hatte mit von vom zu zum zur bei im in am an auf aus für über unter nach vor durch als wie weil da wenn während
        obwohl dass ob noch nur auch sich sie er es wir ich man was wer wo warum ohne kein keine ja nein zwischen""",
    "fr": """le la les l un une des du de d et ou mais ne pas est sont était a ont avait été dans en sur sous avec sans pour par à au
        aux chez qui que qu quoi dont où comment pourquoi quand si ce cette ces cet il elle on nous vous ils elles se son sa ses
        leur plus moins car parce puis après avant entre oui non faut peut reste""",
    "es": """el la los las un una unos unas del de al y o pero no es son era fue ha han había en sobre bajo con sin para por a ante
        que quien qué quién cómo cuándo dónde cuál cual si este esta estos estas ese esa se su sus lo le les más menos porque ya
        aunque después antes entre tras desde hasta sí hay puede permanece""",
}
# The same for languages in which answers may stray.
OTHER_STOP_WORDS = {
    "it": """il lo la i gli le un una uno di del della dello dei degli delle da dal dalla in nel nella nei con su sul sulla per tra fra e ed o ma non è sono
        era ha hanno che chi cui come quando dove perché se anche più molto questo questa questi queste viene nessuno essere stato""",
    "pt": """o a os as um uma uns umas de do da dos das em no na nos nas com por para pelo pela e ou mas não é são era foi tem têm que quem como quando onde
        porque se também mais muito este esta isto esse essa seu sua ao à até já""",
    "nl": """de het een en of maar niet is zijn was waren wordt worden heeft hebben van in op aan met voor door bij naar uit over onder na om te dat die
        dit deze wie wat waar hoe als ook nog wel geen er ze hij zij wij meer dan""",
    "sv": """en ett den det de och eller men inte är var har hade som att på av med för till från vid om under över efter när där vad vem hur också mer än
        den här man sig sin sitt kan ska blir""",
    "pl": """i w we na z ze do od po za o u przez dla przy nie jest są był była było być się że który która które co kto jak gdy gdzie czy ale oraz lub
        także już tylko jego jej ich ten ta to te""",
}
LANGUAGE_OF, VOTERS = {}, {}
for _lang, _words in (STOP_WORDS | OTHER_STOP_WORDS).items():
    for _w in dict.fromkeys(_words.split()):
        VOTERS.setdefault(_w, []).append(_lang)
        if _lang in STOP_WORDS:
            LANGUAGE_OF.setdefault(_w, []).append(_lang)
LANGUAGES = (*STOP_WORDS, *OTHER_STOP_WORDS)
# Languages by their names in instructions.
LANGUAGE_NAMES = {
    "en": "english englisch englischer englischen anglais anglaise inglés inglesa ingles",
    "de": "german deutsch deutscher deutschen allemand allemande alemán alemana aleman",
    "fr": "french französisch französischer französischen français française francés francesa frances francais",
    "es": "spanish spanisch spanischer spanischen espagnol espagnole español española castellano espanol",
    "it": "italian italienisch italien italienne italiano italiana",
    "pt": "portuguese portugiesisch portugais portugués portuguesa português",
    "nl": "dutch niederländisch néerlandais holandés neerlandés",
    "sv": "swedish schwedisch suédois sueco",
    "pl": "polish polnisch polonais polaco",
    "cyrillic": "russian russisch russe ruso rusa",
    "cjk": "chinese japanese chinesisch japanisch chinois japonais chino japonés mandarin",
    "arabic": "arabic arabisch arabe árabe",
    "devanagari": "hindi",
    "thai": "thai thailändisch thaï tailandés",
}
LANGUAGE_NAMED = {w: k for k, names in LANGUAGE_NAMES.items() for w in names.split()}
SCRIPTS = {
    "cyrillic": re.compile("[Ѐ-ӿ]"),
    "cjk": re.compile("[぀-ヿ㐀-鿿]"),
    "arabic": re.compile("[؀-ۿ]"),
    "devanagari": re.compile("[ऀ-ॿ]"),
    "thai": re.compile("[฀-๿]"),
    "hangul": re.compile("[가-힣]"),
    "greek": re.compile("[Ͱ-Ͽ]"),
    "hebrew": re.compile("[֐-׿]"),
}
UNSPACED = re.compile("[฀-๿぀-ヿ㐀-鿿]")
WIDE = re.compile("[Ͱ-ӿ֐-ۿऀ-ॿ฀-๿぀-ヿ㐀-鿿가-힣]")
# Phrases by which a writer declines, and by which they do so politely. Apostrophes are straight.
REFUSAL_PHRASES = """i cannot answer|i can't answer|i cannot help|i can't help|i cannot assist|i can't assist|i cannot provide|i can't provide|
i cannot respond|i can't respond|i cannot say|i can't say|i cannot comment|i can't comment|i cannot give|i can't give|i cannot tell|i can't tell|i cannot share|i can't share|i am not able to|i'm not able to|i am unable to|i'm unable to|
i won't be able to|i will not be able to|i must decline|i have to decline|i would rather not|i'd rather not|i prefer not to|i don't have enough|
i do not have enough|i don't have the information|i do not have the information|i don't have access|i do not have access|i don't know|i do not know|i cannot discuss|i can't discuss|no reply can be given|no answer can be given|
it is not possible for me|it's not possible for me|i decline to|i refuse to|i am not allowed to|i'm not allowed to|i cannot fulfill|i can't fulfill|i cannot comply|i can't comply|unable to answer|unable to help|cannot be answered by me|
je ne peux pas|je ne peux rien|je ne suis pas en mesure|je ne puis|je ne saurais|je préfère ne pas|je dois refuser|je ne dispose pas|je n'ai pas assez|je n'ai pas suffisamment|
il m'est impossible|il ne m'est pas possible|je refuse de|je ne sais pas|je regrette de ne pas pouvoir|je suis dans l'impossibilité|
no puedo|no me es posible|me es imposible|prefiero no|no estoy en condiciones|no dispongo|no tengo suficiente|debo rechazar|no soy capaz|me niego a|no sé|no podré|me faltan|me falta información|il me manque|je manque d"""
POLITE_PHRASES = """please ask|please consult|please contact|please try|ask a qualified|is there something else|is there anything else|can i help with something|
let me know if|i hope you understand|thank you for asking|thank you for your|bitte fragen|bitte wenden|haben sie noch|kann ich sonst|kann ich ihnen sonst|danke für|posez une autre|veuillez consulter|
veuillez poser|adressez-vous|merci de|puis-je vous aider|consulte con|consulte a|pregunte a|haga otra pregunta|plantee otra|gracias por|puedo ayudarle en otra|hay algo más"""
APOLOGIES = """i'm sorry|i am sorry|sorry|apologies|my apologies|unfortunately|i apologize|i regret|leider|es tut mir leid|tut mir leid|entschuldigung|bedaure|bedauerlicherweise|
désolé|désolée|je suis désolé|malheureusement|je regrette|hélas|lo siento|lo lamento|por desgracia|desgraciadamente|lamentablemente|disculpe|perdón|me temo"""
GERMAN_REFUSAL = re.compile(
    r"\b(?:kann|darf|möchte|will|werde|bin|habe)\b(?: leider)? (?:ich|mir)\b.*\b(?:nicht|nichts|keine|keinen)\b.*|\bich\b (?:leider )?(?:kann|darf|möchte|will|werde|bin|habe|weiß)\b.*\b(?:nicht|nichts|keine|keinen)\b.*|\bich muss\b.*\bablehnen\b|\b(?:ist es mir|es ist mir|ist mir) .*(?:nicht möglich|unmöglich)\b.*|\bmuss ich\b.*\b(?:ablehnen|passen)\b|\b(?:fehlen|fehlt) (?:mir|uns)\b.*|\bmir (?:fehlen|fehlt)\b.*"
)
GERMAN_OBJECT = re.compile(r"\b(?:frage|dazu|darüber|antwort|antworten|beantworten|helfen|weiterhelfen|auskunft|äußern|sagen|information|informationen|angaben|daten|kenntnisse|wissen|ablehnen|möglich|unmöglich|lage|passen)\b")
CONTRAST = re.compile(r"\b(?:but|however|yet|still|though|aber|jedoch|doch|mais|cependant|toutefois|pero|sin embargo)\b")
SENTENCE_END = re.compile(r"[.!?…。！？؟]+[\"'”’»」』)\]]*(?=\s|$)|[。！？]")
FINAL = re.compile(r"[.!?…。！？؟।:;]*[.!?。！？؟।][\"'”’»“」』)\]*_`]*\s*$")
LIST_ITEM = re.compile(r"\s*(?:[-*•‣–]|\d{1,3}[.)])\s+(.*)$")
BARE_ITEM = re.compile(r"(?:[-*•‣–]|\d{1,3}[.)])\s*$")
# Words that a complete answer does not end with (articles, prepositions, conjunctions).
NEVER_LAST = frozenset(
    """the a an of and or to with in on at by for from as that which who because since although while if when than into near under over but its their
    der die das des dem den ein eine einer einem einen und oder mit von zu zum zur bei im in am an auf aus für über unter nach vor weil da wenn als dass
    le la les un une des du de et ou à au aux dans sur sous avec sans pour par chez que qui car
    el los las una del al y o en con sin para por sobre bajo porque""".split()
)
#: Shares of an answer's words copied from the question, and of the question's words copied, that make a copy.
COPIED, COPIED_OF_QUESTION = 0.9, 0.5


def _automaton(phrases: str) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for p in phrases.split("|"):
        p = p.strip()
        a.add_word(f" {p}", len(p))
    a.make_automaton()
    return a


REFUSES, POLITE, SORRY = _automaton(REFUSAL_PHRASES), _automaton(POLITE_PHRASES), _automaton(APOLOGIES)


class SuffixAutomaton:
    """Over a sequence of words; ``matches`` gives the longest copied run that ends at each word of another sequence."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.size = [-1], [0]
        last = 0
        for w in words:
            cur = len(self.next)
            self.next.append({})
            self.size.append(self.size[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                if self.size[p] + 1 == self.size[q]:
                    self.link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.size.append(self.size[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(w) == q:
                        self.next[p][w] = clone
                        p = self.link[p]
                    self.link[q] = self.link[cur] = clone
            last = cur

    def matches(self, words: list[str]) -> list[int]:
        out, state, n = [], 0, 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.size[state]
            if w in self.next[state]:
                state = self.next[state][w]
                n += 1
            out.append(n)
        return out

    def covered(self, words: list[str], least: int = 2) -> int:
        """How many of ``words`` lie in copied runs of at least ``least`` words."""
        runs, total, until = self.matches(words), 0, len(words)
        for i in range(len(words) - 1, -1, -1):
            if runs[i] >= least and i < until:
                start = i - runs[i] + 1
                total += i - start + 1
                until = start
        return total


def script_of(text: str) -> str | None:
    """The script of most letters if it isn't Latin."""
    if text.isascii() or not WIDE.search(text):
        return None
    counts = {k: len(p.findall(text)) for k, p in SCRIPTS.items()}
    best = max(counts, key=counts.get)
    latin = len(re.findall(r"[A-Za-zÀ-ɏ]", text))
    # A name or number in Latin letters doesn't make a foreign sentence Latin; one sign of CJK is about two letters.
    return best if counts[best] * (2 if best in ("cjk", "hangul") else 1) > latin else None


def units(text: str) -> list[str]:
    """Words in lower case; in scripts without spaces each letter is one."""
    words = WORD.findall(text.lower())
    if text.isascii() or not UNSPACED.search(text):
        return words
    return [x for w in words for x in (w if UNSPACED.search(w) else [w])]


def votes(words: list[str]) -> dict[str, int]:
    n = dict.fromkeys(LANGUAGES, 0)
    for w in words:
        for lang in VOTERS.get(w, ()):
            n[lang] += 1
    return n


def language_differs(question: str, q_words: list[str], answer: str, a_words: list[str], instruction: str) -> bool:
    """Whether the answer's stop words (or script) vote for another language than the question's; languages with equal
    votes stand together."""
    there, here = script_of(question), script_of(answer)
    langs = {here}
    if here == there is None:
        a, q = votes(a_words), votes(q_words)
        most, asked_most = max(a.values()), max(q.values())
        if not asked_most:
            return False
        own = max(a[k] for k in LANGUAGES if q[k] == asked_most)
        langs = {k for k in LANGUAGES if a[k] == most}
        if own == most or most < 2 or most - own < max(2, 0.15 * len(a_words)) and not (own == 0 and len(a_words) <= 8):
            return False
    elif here == there:
        return False
    elif here is None:
        a = votes(a_words)
        most = max(a.values())
        langs = {k for k in LANGUAGES if a[k] == most}
        if most < 2:
            return False
    asked = {LANGUAGE_NAMED[w] for w in WORD.findall(instruction.lower()) if w in LANGUAGE_NAMED} if instruction else set()
    return langs.isdisjoint(asked)


def only_declines(answer: str) -> bool:
    text = " " + " ".join(answer.lower().replace("’", "'").split())
    if text[1:2] in "\"“„«":
        return False
    phrase = any(True for _ in REFUSES.iter(text))
    declined, at = False, 0
    for e in chain((m.end() for m in SENTENCE_END.finditer(text)), [len(text)]):
        s, at = text[at:e], e
        words = WORD.findall(s)
        if not words:
            continue
        s = " " + s.strip(" \"'")
        hit = max((end + 1 for end, _ in REFUSES.iter(s)), default=0)
        if not hit and (m := GERMAN_REFUSAL.search(s)) and GERMAN_OBJECT.search(m[0]):
            hit = m.end()
        if hit:
            lead = s[:hit]
            if CONTRAST.search(s[hit:]):
                return False
            if ' "' in lead or "“" in lead or re.search(r"\b(?:said|says|wrote|noted|that they|sagte|schrieb|a dit|dijo)\b", lead):
                return False
            declined = True
        elif any(True for _ in POLITE.iter(s)):
            pass
        elif any(end <= 30 for end, _ in SORRY.iter(s)) and len(words) <= 8:
            pass
        else:
            return False
    return declined and (phrase or GERMAN_REFUSAL.search(text) is not None)


def breaks_off(answer: str, a_words: list[str]) -> bool:
    text = answer.rstrip()
    if text.endswith(("...", "…")):
        return len(a_words) > 2
    if FINAL.search(text):
        return BARE_ITEM.search(text.rsplit("\n", 1)[-1].strip()) is not None and "\n" in text
    stack = []
    for c in text:
        if c in "([{":
            stack.append(c)
        elif c in ")]}" and stack and stack[-1] == "([{"[")]}".index(c)]:
            stack.pop()
    if stack:
        return True
    if text.endswith(("-", ",", "–", "—", ":", "(", "/", "&", "‐", "­")):
        return len(a_words) > 0
    lines = [x for x in text.split("\n") if x.strip()]
    items = [m[1] for x in lines if (m := LIST_ITEM.match(x))]
    if len(lines) > 1 and (items or BARE_ITEM.match(lines[-1].strip())):
        if BARE_ITEM.match(lines[-1].strip()):
            return True
        # In a list, the last item breaks off if the others are closed, or if it stops behind an article or the like.
        others = items[:-1]
        if others and all(x.rstrip()[-1:] in ".!?;," for x in others if x.strip()):
            return True
        return bool(a_words) and a_words[-1] in NEVER_LAST
    if a_words and a_words[-1] in NEVER_LAST and len(a_words) > 1:
        return True
    if SENTENCE_END.search(text[:-1]) and re.search(r"[^\W\d_]{3,}[.!?]\s", text):
        return True  # closed sentences before an open one
    return len(a_words) > 12


def defect(question: str | None, answer: str | None, instruction: str | None) -> str | None:
    answer = answer or ""
    a_words = units(answer)
    bare = "".join(a_words)
    if not bare or bare in STAND_INS and not re.search(r"\w{3,}\s+\w", answer.strip("[](){}<>\"' ")) and not answer.strip().lower() == "a":
        return "empty"
    if bare in STAND_INS and len(a_words) > 1:
        return "empty"
    question = question or ""
    q_words = units(question)
    if language_differs(question, q_words, answer, a_words, instruction or ""):
        return "other_language"
    if len(a_words) >= 3 and len(q_words) >= 3:
        known = set(q_words)
        # Copied words are known words, so only answers with enough of these need the automaton.
        if sum(w in known for w in a_words) >= COPIED * len(a_words):
            copied = SuffixAutomaton(q_words).covered(a_words)
            if copied >= COPIED * len(a_words) and copied >= COPIED_OF_QUESTION * len(q_words):
                return "copies_question"
    if only_declines(answer):
        return "refusal"
    if breaks_off(answer, a_words):
        return "truncated"
    return None


def defects(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """``key, defect`` of the defective pairs (``question``, ``answer``, ``instruction``), a row a pair."""
    kind = dict(pairs.dtypes)[key]

    def make():
        def f(batch):
            ids, found = [], []
            for k, q, a, i in zip(*(c.to_pylist() for c in batch.columns)):
                if d := defect(q, a, i):
                    ids.append(k)
                    found.append(d)
            return ids, found

        return f

    return map_rows(pairs.select(key, "question", "answer", "instruction"), make, f"{key} {kind}, defect string").groupBy(key).agg({"defect": "min"}).withColumnRenamed("min(defect)", "defect")

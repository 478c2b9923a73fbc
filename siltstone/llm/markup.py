"""Markup residue in text documents: which kinds a text holds, and clean text that keeps its structure.

Recognisers find the marks of HTML, Markdown, wiki and LaTeX in single texts. Over all pages of one host (here: one
folder of ``source``) templates are deduced from equivalence classes: tags and stretches of text, told apart by their
paths of elements, that occur equally often on the same pages form a class; classes whose tokens keep one order, and
which are nested in each other without overlap on all their pages, are the template of the host. Its text (navigation,
footers) is taken out of the clean text, so that the slots remain. Code, tables, headings, formulas and the lists of the
content are never template. Occurrence vectors are compared by a sum of hashes; orders and nesting are checked page by
page and compared over pages, so no list of pages is ever gathered.

Null and empty texts have no kind and an empty clean text. Very long texts are processed whole. Repeated rows are
dropped by key by the callers.
"""

from __future__ import annotations

import hashlib
import html
import re
import string
from html.entities import html5

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.io import cut
from siltstone.llm.common import map_rows

# Element names of HTML.
TAGS = frozenset(
    """a abbr address area article aside audio b base big blockquote body br button canvas caption center cite code col colgroup dd del details
    dfn dialog div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img
    input ins kbd label legend li link main map mark meta nav noscript object ol optgroup option p param picture pre q s samp script section
    select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr""".split()
)
BARE = r"(?:disabled|checked|selected|readonly|required|hidden|async|defer|multiple|nowrap|controls|autoplay|loop|open|noshade|compact)"
TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)((?:\s+(?:[a-zA-Z_:@][-\w:.]*\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>]+)|" + BARE + r"\b))*)\s*/?>")
DECLARATION = re.compile(r"<!DOCTYPE\b[^<>]*>|<!--|<!\[CDATA\[|<\?xml\b", re.I)
ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});")

# Markdown, each with the sign that must occur for it to be worth a search.
MARKDOWN = (
    ("#", re.compile(r"^#{2,6}[ \t]+\S|(?:\A|\n[ \t]*\n)#[ \t]+\S[^\n]*(?=\n[ \t]*\n|\n?\Z|\n#{2,6} )", re.M)),
    ("](", re.compile(r"\[[^\[\]\n]*\]\([^()\s]+(?:\([^()\s]*\))?(?:\s+\"[^\"\n]*\")?\)")),
    ("][", re.compile(r"\[[^\[\]\n]+\]\[[^\[\]\n]*\](?!\])")),
    ("]:", re.compile(r"^ {0,3}\[[^\[\]\n]+\]:\s+\S+\s*$", re.M)),
    ("**", re.compile(r"(?<![*\w])\*\*(?=[^\s*])[^*\n]+(?<=[^\s*])\*\*(?![*\w])")),
    ("__", re.compile(r"(?<![\w.])__(?=[^\s_])(?!(?:init|main|name|file|doc|all|dict|class|call|str|repr|len|enter|exit|new|del|iter|next|getitem|setitem|version|author)__)[^_\n]+(?<=[^\s_])__(?![\w(.])")),
    ("*", re.compile(r"(?<![*\w\\)])\*(?=[^\s*])[^*\n]+(?<=[^\s*])\*(?![*\w])")),
    ("_", re.compile(r"(?<![\w/\\.:~-])_(?=[^\s_])[^_\n/\\]+(?<=[^\s_])_(?![\w(.=/\\])")),
    ("~~", re.compile(r"(?<!~)~~(?=[^\s~])[^~\n]+(?<=[^\s~])~~(?!~)")),
    ("`", re.compile(r"^ {0,3}```|^ {0,3}~~~\w*$|(?<!`)`(?!`)[^`\n]+`(?!`)", re.M)),
    (">", re.compile(r"^ {0,3}> ?\S", re.M)),
    ("|", re.compile(r"^ {0,3}\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$", re.M)),
    ("==", re.compile(r"^[^\s=|][^\n]*\n={4,}[ \t]*$", re.M)),
    ("--", re.compile(r"(?:\A|\n[ \t]*\n)[^\s|+*\-][^\n|]*\n-{4,}[ \t]*(?=\n|\Z)")),
    ("- [", re.compile(r"^\s*[-*] \[[ xX]\] \S", re.M)),
)
# Headings of the project's own sections, which are no markup.
OWN_SECTION = r"(?:Document Text|Visual Content|Image Content|Document|Visual|Page|Slide|Sheet|Image|Text|Section|Attachment|Table|End|OCR|File|Source)\b"
WIKI = (
    ("==", re.compile(r"^(={2,6})(?!=)[ \t]*(?!" + OWN_SECTION + r")(?=\S)[^\n]*?[^\s=][ \t]*\1[ \t]*$", re.M)),
    ("[[", re.compile(r"\[\[[^\[\]\n]+\]\]")),
    ("{{", re.compile(r"\{\{[^{}\n]+(?:\n[|}][^{}]*)?\}\}|^\{\{[A-Za-z][^{}]*\}\}", re.M)),
    ("{|", re.compile(r"^\{\|[^\n]*\n(?:.*\n)*?\|\}", re.M)),
    ("'''", re.compile(r"'''(?=\S)[^\n]+?(?<=\S)'''")),
    ("''", re.compile(r"(?<!['`\w])''(?=[^\s'])(?:[^'\n]|'(?!'))+(?<=[^\s'])''(?!['\w])")),
    ("[http", re.compile(r"\[https?://\S+ [^\[\]\n]+\](?!\()")),
    ("#R", re.compile(r"^#REDIRECT\s*\[\[", re.M)),
    ("__", re.compile(r"__(?:TOC|NOTOC|NOEDITSECTION|FORCETOC)__")),
    ("<", re.compile(r"<(?:ref|nowiki|references|gallery|math)\b[^<>]*>")),
)
PATH = re.compile(r"(?<![\w\\])(?:[A-Za-z]:\\|\\\\)[^\s\"'<>|]*|(?<![\w\\])(?:[\w.-]+\\){2,}[\w.-]*")
# LaTeX commands that stand without an argument.
COMMANDS = (
    "item it bf em tt sc rm sf maketitle tableofcontents newpage clearpage noindent par centering hline toprule midrule bottomrule LaTeX TeX ldots dots cdots "
    "quad qquad smallskip medskip bigskip large Large small footnotesize appendix alpha beta gamma delta Delta epsilon lambda mu pi sigma Sigma omega Omega theta phi "
    "cdot times leq geq neq le ge ne approx infty sum int prod partial nabla in to rightarrow Rightarrow left right pm frac sqrt raggedright today linebreak pagebreak "
    "printbibliography newline hfill vfill indent null displaystyle textstyle protect par bigskip item"
)
LATEX = (
    ("\\", re.compile(r"\\(?:begin|end)\{[A-Za-z*]+\}|\\[a-zA-Z]{2,}\*?(?:\[[^\]\n]*\])?\{|\\(?:" + "|".join(sorted(set(COMMANDS.split()), key=lambda w: (-len(w), w))) + r")(?![a-zA-Z])|\\[(\[]|\\[%&_#$]|\\\\(?:[ \t]*\\hline|[ \t]*$)", re.M)),
    ("$", re.compile(r"\$\$(?=\s*\S)[^$]+\$\$|(?<![\w$\\])\$(?![\s$])(?:[A-Za-z]|(?=[^$\n]*[\\^_={}+<>*/])(?!\d+(?:[.,]\d+)?(?:[ -]|\b(?![\^_\\={}+*/a-z])))[^$\n]{2,})(?<!\s)\$(?![\w$])")),
)
KINDS = ("html", "markdown", "wiki", "latex")


def has_html(text: str) -> bool:
    if "<" in text:
        if DECLARATION.search(text):
            return True
        for m in TAG.finditer(text):
            if m[1].lower() in TAGS:
                return True
    if "&" in text:
        for m in ENTITY.finditer(text):
            if m[0][1] == "#" or m[0][1:] in html5:
                return True
    return False


def _any(patterns, text: str) -> bool:
    return any(sign in text and p.search(text) for sign, p in patterns)


def without_code(text: str) -> str:
    """``text`` without the insides of code (HTML and Markdown), where signs are not markup."""
    if "```" in text:
        text = re.sub(r"(?m)^ {0,3}```[^\n]*\n(?:.*\n)*?^ {0,3}```[ \t]*$", "```\n\n```", text)
    if "<" in text:
        text = re.sub(r"(?is)<(pre|code|script|style|nowiki)\b[^>]*>.*?</\1>", r"<\1></\1>", text)
    return text


def markup_kinds(text: str | None) -> list[str]:
    """The kinds of markup in ``text``, in the order of ``KINDS``."""
    if not text:
        return []
    found = ["html"] if has_html(text) else []
    bare = without_code(text)
    if "\\" in bare:
        bare = PATH.sub(lambda m: " " if not re.match(r"\\(?:\\|begin|end)", m[0]) or ":" in m[0] else m[0], bare)
    latex = _any(LATEX, bare)
    if _any(MARKDOWN, bare if not latex else re.sub(r"``[^`\n]*''|\$[^$\n]*\$", " ", bare)):
        found.append("markdown")
    if _any(WIKI, bare if not latex else re.sub(r"``[^`\n]*''", " ", bare)):
        found.append("wiki")
    if latex:
        found.append("latex")
    return found


def kinds_of(docs: DataFrame, key: str = "doc_id", text: str = "content") -> DataFrame:
    """``key, markup``: a row for each kind of markup found."""
    kind = dict(docs.dtypes)[key]

    def make():
        def f(batch):
            ids, found = [], []
            for k, t in zip(*(c.to_pylist() for c in batch.columns)):
                for m in markup_kinds(t):
                    ids.append(k)
                    found.append(m)
            return ids, found

        return f

    return map_rows(docs.select(key, text).where(F.col(text).isNotNull()), make, f"{key} {kind}, markup string").distinct()


# --- clean text -----------------------------------------------------------------------------------------------------
# The clean text uses one notation: "# " headings by level, "- " and "1. " lists, fenced code, "| a | b |" tables, "$…$" formulas.


def _table(rows: list[list[str]]) -> str:
    return "\n\n" + "\n".join("| " + " | ".join(" ".join(c.split()) for c in r) + " |" for r in rows if r) + "\n\n"


def clean_html(t: str) -> str:
    t = re.sub(r"(?is)<!--.*?-->|<!DOCTYPE[^>]*>|<\?xml.*?\?>|<(script|style|head|template)\b.*?</\1\s*>", "", t)
    held: list[str] = []

    def hold(code: str) -> str:
        held.append("\n```\n" + html.unescape(re.sub(r"<[^>]*>", "", code)).strip("\n") + "\n```\n")
        return f"\n\n\x00{len(held) - 1}\x00\n\n"

    t = re.sub(r"(?is)<pre\b[^>]*>(.*?)</pre\s*>", lambda m: hold(m[1]), t)
    t = re.sub(r"(?is)<table\b[^>]*>(.*?)</table\s*>", lambda m: _table([[re.sub(r"<[^>]*>", " ", c) for c in re.findall(r"(?is)<t[dh]\b[^>]*>(.*?)(?=</?t[dhr]\b|\Z)", r)] for r in re.split(r"(?i)<tr\b[^>]*>", m[1])]), t)
    t = re.sub(r"(?is)<h([1-6])\b[^>]*>(.*?)</h\1\s*>", lambda m: "\n\n" + "#" * int(m[1]) + " " + " ".join(m[2].split()) + "\n\n", t)

    def ordered(m):
        n = iter(range(1, 1_000_000))
        return "\n\n" + re.sub(r"(?i)<li\b[^>]*>\s*", lambda _: f"\n{next(n)}. ", m[1]) + "\n\n"

    t = re.sub(r"(?is)<ol\b[^>]*>(.*?)</ol\s*>", ordered, t)
    t = re.sub(r"(?i)<li\b[^>]*>\s*", "\n- ", t)
    t = re.sub(r"(?i)<br\s*/?>", " ", t)
    t = re.sub(r"(?i)</?(?:p|div|ul|ol|dl|dd|dt|section|article|blockquote|body|html|hr|header|footer|nav|main|figure|center|form|tr)\b[^>]*>", "\n\n", t)
    t = TAG.sub(lambda m: "" if m[1].lower() in TAGS else m[0], t)
    t = ENTITY.sub(lambda m: html.unescape(m[0]), t).replace("\xa0", " ")
    return re.sub(r"\x00(\d+)\x00", lambda m: held[int(m[1])], t)


def without_nested(t: str) -> str:
    """``t`` without what stands in paired double braces, however deep they are nested."""
    if "{{" not in t:
        return t
    opened: list[int] = []
    spans: list[tuple[int, int]] = []
    for m in re.finditer(r"\{\{|\}\}", t):
        if m[0] == "{{":
            opened.append(m.start())
        elif opened:
            a = opened.pop()
            while spans and spans[-1][0] > a:
                spans.pop()
            spans.append((a, m.end()))
    out, at = [], 0
    for a, b in spans:
        out.append(t[at:a])
        at = b
    return "".join(out) + t[at:]


def clean_wiki(t: str) -> str:
    t = re.sub(r"(?is)<ref\b[^>/]*>.*?</ref>|<ref\b[^>]*/>|<references\s*/>|__(?:NO)?TOC__", "", t)
    t = without_nested(t)
    t = re.sub(r"\[\[(?:Category|Kategorie|Catégorie|Categoría|File|Image|Datei|Fichier|Archivo):[^\[\]]*\]\]", "", t, flags=re.I)
    t = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", t)
    t = re.sub(r"\[https?://\S+ ([^\[\]\n]+)\]", r"\1", t)
    t = re.sub(r"'''''|'''|(?<![\w`])''(?=\S)|(?<=\S)''(?!\w)", "", t)

    def table(m):
        rows = [re.split(r"\|\||!!|\n[|!](?![-}])", "\n" + r.strip("\n")) for r in re.split(r"\n\|-[^\n]*", m[1])]
        return _table([[c for c in r[1:]] for r in rows if len(r) > 1])

    t = re.sub(r"(?ms)^\{\|[^\n]*(\n.*?)^\|\}", table, t)
    t = re.sub(r"(?m)^#+[ \t]+", "1. ", t)
    t = re.sub(r"(?m)^\*+[ \t]*(?=\S)", "- ", t)
    return re.sub(r"(?m)^(={2,6})[ \t]*(\S[^\n]*?)[ \t]*\1[ \t]*$", lambda m: m[0] if re.match(OWN_SECTION, m[2]) else "#" * (len(m[1]) - 1) + " " + m[2], t)


def clean_latex(t: str) -> str:
    t = re.sub(r"(?m)(?<!\\)%(?=[ \t]).*$", "", t)
    t = re.sub(r"\\documentclass(?:\[[^\]]*\])?\{[^}]*\}|\\usepackage(?:\[[^\]]*\])?\{[^}]*\}|\\(?:begin|end)\{document\}|\\maketitle|\\tableofcontents|\\label\{[^}]*\}|\\(?:h|v)space\*?\{[^}]*\}", "", t)
    t = re.sub(r"\\title\{([^{}]*)\}", r"\n\n# \1\n\n", t)
    for level, name in enumerate(("chapter", "section", "subsection", "subsubsection", "paragraph"), 1):
        t = re.sub(r"\\%s\*?(?:\[[^\]]*\])?\{([^{}]*)\}" % name, lambda m, h="#" * level: f"\n\n{h} {m[1]}\n\n", t)
    t = re.sub(r"(?s)\\begin\{(verbatim|lstlisting|minted)\}(?:\[[^\]]*\])?(.*?)\\end\{\1\}", lambda m: "\n\n```\n" + m[2].strip("\n") + "\n```\n\n", t)
    t = re.sub(r"(?s)\\begin\{(equation\*?|align\*?|displaymath|gather\*?|math)\}(.*?)\\end\{\1\}", lambda m: "\n\n$$" + m[2].strip() + "$$\n\n", t)
    t = re.sub(r"(?s)\\\[(.*?)\\\]", lambda m: "$$" + m[1].strip() + "$$", t)
    t = re.sub(r"(?s)\\\((.*?)\\\)", lambda m: "$" + m[1].strip() + "$", t)
    t = re.sub(r"(?s)\\begin\{tabular\*?\}(?:\{[^{}]*\})*(.*?)\\end\{tabular\*?\}", lambda m: _table([re.split(r"(?<!\\)&", r) for r in re.split(r"\\\\", re.sub(r"\\(?:hline|toprule|midrule|bottomrule)", "", m[1])) if r.strip()]), t)

    def ordered(m):
        n = iter(range(1, 1_000_000))
        return re.sub(r"\\item\b[ \t]*", lambda _: f"{next(n)}. ", m[1])

    t = re.sub(r"(?s)\\begin\{enumerate\}(?:\[[^\]]*\])?(.*?)\\end\{enumerate\}", ordered, t)
    t = re.sub(r"\\item\b(?:\[([^\]]*)\])?[ \t]*", r"- \1", t)
    t = re.sub(r"\\(?:begin|end)\{[A-Za-z*]+\}(?:\[[^\]]*\])?", "", t)
    formulas: list[str] = []

    def hold(m):
        formulas.append(m[0])
        return f"\x01{len(formulas) - 1}\x01"

    t = re.sub(r"\$\$[^$]+\$\$|\$(?!\s)[^$\n]+\$", hold, t)
    t = re.sub(r"~?\\(?:cite[tp]?|ref|eqref|pageref)\*?(?:\[[^\]]*\])*\{[^{}]*\}", "", t)
    t = re.sub(r"\\footnote\{([^{}]*)\}", r" (\1)", t)
    t = re.sub(r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1", t)
    before = None
    while t != before:  # from the inside out
        before = t
        t = re.sub(r"\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{([^{}]*)\}", r"\1", t)
        t = re.sub(r"\{\\[a-zA-Z]+\s+([^{}]*)\}", r"\1", t)
    t = re.sub(r"\\([%&_#$])", r"\1", t)
    t = re.sub(r"``([^`\n]*)''", r"“\1”", t)
    t = re.sub(r"\\(?:%s)(?![a-zA-Z])[ \t]?|\\\\" % "|".join(sorted(set(COMMANDS.split()), key=lambda w: (-len(w), w))), "", t).replace("~", " ")
    return re.sub(r"\x01(\d+)\x01", lambda m: formulas[int(m[1])], t)


def clean_markdown(t: str) -> str:
    parts = re.split(r"(?m)(^ {0,3}```[^\n]*\n(?:.*\n)*?^ {0,3}```[ \t]*$)", t)
    for i in range(0, len(parts), 2):
        p = parts[i]
        p = re.sub(r"(?m)^([^\s=|][^\n]*)\n={4,}[ \t]*$", r"# \1", p)
        p = re.sub(r"(?m)(\A|\n\n)([^\s|+*\-][^\n|]*)\n-{4,}[ \t]*$", r"\1## \2", p)
        p = re.sub(r"(?m)^ {0,3}(?:> ?)+", "", p)
        p = re.sub(r"!\[([^\[\]\n]*)\]\([^()\s]*\)", r"\1", p)
        p = re.sub(r"\[([^\[\]\n]*)\]\([^()\s]+(?:\s+\"[^\"\n]*\")?\)", r"\1", p)
        p = re.sub(r"(?m)^ {0,3}\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*\n?", "", p)
        for mark in (r"\*\*", "__", "~~", r"\*"):
            p = re.sub(r"(?<![\w%s])%s(?=\S)([^\n]+?)(?<=\S)%s(?!\w)" % (mark[-1] if mark[-1] != "*" else "*", mark, mark), r"\1", p)
        p = re.sub(r"(?<!`)`([^`\n]+)`(?!`)", r"\1", p)
        p = re.sub(r"(?m)^([ \t]*)[*+][ \t]+", r"\1- ", p)
        parts[i] = p
    return "".join(parts)


# --- templates ------------------------------------------------------------------------------------------------------

# Tags of HTML, and stretches of text between them and line breaks; other angle brackets belong to the text.
_NAMES = "|".join(sorted(TAGS, key=lambda n: (-len(n), n)))
_MARK = rf"</?(?i:{_NAMES})(?:\s+{BARE}\b)*\s*/?>|</?(?i:{_NAMES})\s[^<>]*=[^<>]*>|<![^<>]*>|<\?[^<>]*>"
TOKEN = re.compile(rf"(?P<tag>{_MARK})|(?P<line>\n)|(?:[^<\n]+|(?!{_MARK})<)+")
# Elements without an end, elements that end where their like begins, and elements by what they hold.
VOID = frozenset("area base br col embed hr img input link meta source track wbr frame".split())
ENDS_ITSELF = frozenset("li p tr td th dt dd option".split())
KEPT = frozenset("pre code script style textarea table th td h1 h2 h3 h4 h5 h6 math svg kbd samp".split())
FURNITURE = frozenset("nav header footer aside menu a".split())
SIGNS = frozenset(string.punctuation)
#: What is left of a line whose texts were all template: list signs, numbers of items, separators.
REST = re.compile(r"\s*(?:\d+\.(?=\s|$))?[\s!-/:-@\[-`{-~–—·•«»‹›→]*")
FENCE = re.compile(r" {0,3}(?:```|~~~)")
ENVIRONMENT = re.compile(r"\\(begin|end)\{(?:verbatim|lstlisting|minted|tabular|equation|align|gather|displaymath|math|itemize|enumerate|description)\*?\}")
#: Lines that are a list entry, table row, heading, formula, marker of the project or indented code.
STRUCTURE = re.compile(r"[ \t]*(?:[-*+•‣◦–·]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)])[ \t]+\S|[ \t]*[|!]|\{\||#{1,6}[ \t]|=+[^=].*=+[ \t]*$|\$\$|\[[A-Z][A-Za-z ]+:|[ ]{4,}\S|\t")
#: Pages on which a class must occur, and tokens it must have.
LEAST_PAGES, LEAST_TOKENS = 3, 3


def token_hash(token: str, path: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{path}\n{token}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def is_structure(token: str) -> bool:
    """Whether a token of text opens, closes or rules off something that spans lines, as tags do in HTML."""
    if SIGNS.issuperset(token.replace(" ", "")):
        return True
    return token.count("{") != token.count("}") or token.count("[") != token.count("]") or token.count("$$") % 2 == 1


def stream(text: str) -> list[tuple[int, int, int, bool, bool]]:
    """The tokens of a page in order: (start, end, hash, whether it is a tag, whether it stands outside all elements).

    Tokens are tags and stretches of text within a line; equal tokens at different paths of elements are different ones.
    Text of code, tables, headings, formulas, and of lists outside navigation is not among them: it is never template.
    """
    out: list[tuple[int, int, int, bool, bool]] = []
    stack: list[str] = []
    kept = 0  # how many open elements hold what is always kept
    fenced = wiki_table = False
    inside = 0  # open LaTeX environments
    line_at, held_line = 0, False

    def begin_line(at: int) -> None:
        nonlocal line_at, held_line, fenced, wiki_table, inside
        line_at = at
        end = text.find("\n", at)
        line = text[at : end if end >= 0 else len(text)]
        held_line = fenced or wiki_table or inside > 0
        if FENCE.match(line):
            fenced, held_line = not fenced, True
        elif not fenced:
            if line.startswith("{|"):
                wiki_table = held_line = True
            elif wiki_table and line.startswith("|}"):
                wiki_table = False
            if "\\" in line:
                for m in ENVIRONMENT.finditer(line):
                    inside = inside + 1 if m[1] == "begin" else max(0, inside - 1)
                    held_line = True
            held_line = held_line or STRUCTURE.match(line) is not None

    begin_line(0)
    for m in TOKEN.finditer(text):
        if m["line"] is not None:
            begin_line(m.end())
            continue
        token = " ".join(m[0].split())
        if not token:
            continue
        if m["tag"] is None:
            if kept or is_structure(token) or not stack and held_line:
                continue
            if stack and ("li" in stack or "dd" in stack or "dt" in stack) and FURNITURE.isdisjoint(stack):
                continue
            if stack and fenced:
                continue
            out.append((m.start(), m.end(), token_hash(token, "/".join(stack)), False, not stack))
            continue
        name = re.match(r"</?([a-zA-Z][a-zA-Z0-9]*)", token)
        name = name[1].lower() if name else ""
        if token.startswith("</"):
            if name in stack:
                while True:
                    top = stack.pop()
                    kept -= top in KEPT
                    if top == name:
                        break
            out.append((m.start(), m.end(), token_hash(token, "/".join(stack)), True, not stack))
        else:
            if stack and stack[-1] == name and name in ENDS_ITSELF:
                kept -= stack.pop() in KEPT
            out.append((m.start(), m.end(), token_hash(token, "/".join(stack)), True, not stack))
            if name and name not in VOID and not token.endswith("/>"):
                stack.append(name)
                kept += name in KEPT
    return out


def class_order(tokens: list[tuple[int, int, list[int]]]) -> list[tuple[int, bool, int, int, int]]:
    """Of each class on a page: (class, regular, hash of the order, parent class or 0, gap of the parent).

    ``tokens``: (class, token, places). A class is regular if its tokens come in one order, again and again, and if no
    occurrence of it overlaps one of another class: all lie in the same gap of the same class around them.
    """
    by_class: dict[int, list[tuple[int, int]]] = {}
    size: dict[int, int] = {}
    for c, token, places in tokens:
        by_class.setdefault(c, []).extend((at, token) for at in places)
        size[c] = size.get(c, 0) + 1
    bad: set[int] = set()
    order: dict[int, int] = {}
    events: list[tuple[int, int, int]] = []
    for c, seq in by_class.items():
        seq.sort()
        k, names = size[c], [t for _, t in seq]
        if len(names) % k or len(set(names[:k])) < k or any(names[i] != names[i % k] for i in range(k, len(names))):
            bad.add(c)
            continue
        order[c] = int.from_bytes(hashlib.blake2b(repr(names[:k]).encode(), digest_size=8).digest(), "little", signed=True)
        events += [(at, c, i % k) for i, (at, _) in enumerate(seq)]
    events.sort()
    parents: dict[int, set[tuple[int, int]]] = {}
    opened: list[list[int]] = []
    for _, c, j in events:
        if j == 0:
            parents.setdefault(c, set()).add((opened[-1][0], opened[-1][1]) if opened else (0, 0))
            opened.append([c, 0])
        else:
            while opened and opened[-1][0] != c and any(o[0] == c for o in opened):
                bad.update((c, opened.pop()[0]))
            if not opened or opened[-1][0] != c:
                bad.add(c)
                continue
            opened[-1][1] = j
        if j == size[c] - 1:
            opened.pop()
    out = []
    for c in by_class:
        around = parents.get(c, set())
        parent, gap = next(iter(around)) if len(around) == 1 else (0, 0)
        out.append((c, c not in bad and len(around) == 1, order.get(c, 0), parent, gap))
    return out


def templates(docs: DataFrame, key: str = "doc_id", host: str = "host", text: str = "content") -> tuple[DataFrame, DataFrame]:
    """The templates of the hosts, and the tokens of text of each page that belong to one.

    Templates: ``host, class, tokens, pages, parent, gap``, a row a valid class; ``parent`` (0: none) is the class in
    whose gap ``gap`` it is nested. Tokens: ``key, token`` (hashes).

    A class is a set of at least ``LEAST_TOKENS`` tokens with one occurrence vector over the host's pages: they occur on
    the same pages (at least ``LEAST_PAGES`` of different content), equally often on each. It is valid if on all its
    pages the tokens come in one order and the class is nested in the same gap of the same class. Only classes that
    occur once a page give text tokens: what is repeated within a page labels its content.
    """
    kind = dict(docs.dtypes)[key]

    def make():
        def f(batch):
            out = [[] for _ in range(6)]
            for h, k, t in zip(*(c.to_pylist() for c in batch.columns)):
                places: dict[int, list[int]] = {}
                tags: set[int] = set()
                for at, (_, _, token, tag, _) in enumerate(stream(t)):
                    places.setdefault(token, []).append(at)
                    if tag:
                        tags.add(token)
                content = token_hash(t, "")
                for token, at in places.items():
                    for column, value in zip(out, (h, k, token, token in tags, content, at)):
                        column.append(value)
            return out

        return f

    tokens = map_rows(docs.select(host, key, text).where(F.col(text).isNotNull()), make, f"host string, page {kind}, token bigint, tag boolean, content bigint, places array<int>")
    tokens = cut(tokens, "tokens")
    n = F.size("places")
    counted = tokens.groupBy("host", "token").agg(F.count("*").alias("pages"), F.sum(F.xxhash64("page", n).cast("decimal(38,0)")).alias("vector"), F.min("content").alias("c1"), F.max("content").alias("c2"))
    vectors = counted.where((F.col("pages") >= LEAST_PAGES) & (F.col("c1") != F.col("c2"))).withColumn("class", F.xxhash64("host", "vector", "pages"))
    sizes = vectors.groupBy("host", "class").agg(F.count("*").alias("tokens")).where(F.col("tokens") >= LEAST_TOKENS)
    members = cut(vectors.select("host", "token", "pages", "class").join(sizes, ["host", "class"]), "members")
    placed = tokens.join(members.select("host", "token", "class", "tokens"), ["host", "token"])
    by_page = placed.groupBy("host", "page").agg(F.collect_list(F.struct("class", "token", "places")).alias("t"), F.first("content").alias("content"))

    def make_order():
        def f(batch):
            out = [[] for _ in range(7)]
            for h, content, ts in zip(*(c.to_pylist() for c in batch.columns)):
                for row in class_order([(x["class"], x["token"], x["places"]) for x in ts]):
                    for column, value in zip(out, (h, content, *row)):
                        column.append(value)
            return out

        return f

    orders = map_rows(by_page.select("host", "content", "t"), make_order, "host string, content bigint, class bigint, regular boolean, ordered bigint, parent bigint, gap int")
    same = lambda c: F.min(c) == F.max(c)
    judged = orders.groupBy("host", "class").agg(F.every("regular").alias("regular"), same("ordered").alias("one_order"), (same("parent") & same("gap")).alias("nested"), F.min("parent").alias("parent"), F.min("gap").alias("gap"), F.count("*").alias("pages"), F.approx_count_distinct("content", 0.01).alias("contents"))
    valid = cut(judged.where((F.col("contents") >= LEAST_PAGES) & F.col("regular") & F.col("one_order") & F.col("nested")).join(sizes, ["host", "class"]).select("host", "class", "tokens", "pages", "parent", "gap"), "templates")
    taken = placed.where((F.size("places") == 1) & ~F.col("tag")).join(valid.select("host", "class"), ["host", "class"], "left_semi")
    return valid, taken.select(F.col("page").alias(key), "token")


def slots(text: str, template: frozenset[int], mark: str) -> str:
    """``text`` with ``mark`` in place of the text of its template; the rest are its slots.

    Outside elements only lines at the top or bottom of the page are taken out, as far as no other line stands before
    (behind) them. If more than half of the text would go, the pages are copies of one text rather than of one template,
    and all of it stays.
    """
    found = [(a, b, outside) for a, b, token, tag, outside in stream(text) if not tag and token in template]
    if not found:
        return text
    free = {a for a, _, outside in found if outside}
    if free:
        lines = [(m.start(), m.end()) for m in re.finditer(r"[^\n]*\S[^\n]*", text)]
        ends = {a: b for a, b, _ in found}
        whole = [any(text[a : x].strip() == "" and text[ends[x] : b].strip() == "" for x in range(a, b) if x in free) if b - a else False for a, b in lines]
        top = next((i for i, w in enumerate(whole) if not w), len(lines))
        bottom = next((i for i, w in enumerate(reversed(whole)) if not w), len(lines))
        edge = [*lines[:top], *lines[len(lines) - bottom :]]
        found = [x for x in found if not x[2] or any(a <= x[0] < b for a, b in edge)]
    if not found or 2 * sum(b - a for a, b, _ in found) > sum(len(m[0].strip()) for m in TOKEN.finditer(text) if m["tag"] is None):
        return text
    out, at = [], 0
    for a, b, _ in found:
        piece = text[a:b]
        out += [text[at : a + len(piece) - len(piece.lstrip())], mark]
        at = a + len(piece.rstrip())
    return "".join(out) + text[at:]


def without_marks(text: str, mark: str) -> str:
    """``text`` without marks, and without the lines that held nothing but template."""
    out = []
    for line in text.split("\n"):
        if mark in line:
            first = line.lstrip(" \t").startswith(mark)
            line = re.sub(rf"[ \t]*{mark}", "", line)
            if REST.fullmatch(line):
                continue
            line = line.lstrip(" \t") if first else line
        out.append(line)
    return "\n".join(out)


def clean_text(text: str | None, template: frozenset[int] = frozenset()) -> str:
    """``text`` without markup and without the text of the host's template (hashes of tokens), in the notation above."""
    if not text:
        return ""
    kinds = markup_kinds(text)
    t = text
    if template:
        mark = next(c for c in map(chr, range(0xE000, 0xF900)) if c not in text)
        t = slots(text, template, mark)
    if "latex" in kinds:
        t = clean_latex(t)
    if "wiki" in kinds:
        t = clean_wiki(t)
    if "html" in kinds:
        t = clean_html(t)
    if "markdown" in kinds:
        t = clean_markdown(t)
    if template:
        t = without_marks(t, mark)
    t = re.sub(r"[ \t]+(?=\n)", "", t)
    t = re.sub(r"(?m)(?<=\S)[ \t]{2,}(?=\S)", " ", t) if kinds else t
    return re.sub(r"\n{3,}", "\n\n", t).strip("\n")


def with_host(docs: DataFrame, source: str = "source") -> DataFrame:
    """``docs`` with ``host``: the folder of the source, null sources in one host of their own."""
    return docs.withColumn("host", F.coalesce(F.regexp_replace(F.lower(F.col(source)), r"/[^/]*$", ""), F.lit("")))


def clean_documents(docs: DataFrame, key: str = "doc_id", text: str = "content", source: str = "source") -> DataFrame:
    """``key, kinds, clean``: a row a document.

    Template tokens reach their pages by a join, so no host's template is gathered in one place.
    """
    kind = dict(docs.dtypes)[key]
    hosted = with_host(docs.select(key, source, text), source)
    _, tokens = templates(hosted, key, "host", text)
    per_doc = tokens.groupBy(key).agg(F.collect_set("token").alias("template"))

    def make():
        def f(batch):
            ids, kinds, clean = [], [], []
            for k, t, template in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(k)
                kinds.append(markup_kinds(t))
                clean.append(clean_text(t, frozenset(template or ())))
            return ids, kinds, clean

        return f

    return map_rows(hosted.select(key, text).join(per_doc, key, "left"), make, f"{key} {kind}, kinds array<string>, clean string")


def host_templates(docs: DataFrame, key: str = "doc_id", text: str = "content", source: str = "source") -> DataFrame:
    """``host, class, tokens, pages, parent, gap``: the templates of all hosts."""
    return templates(with_host(docs.select(key, source, text), source), key, "host", text)[0]

"""Problem 4: unfilled templates, filler text, error pages and notices that scripts are required.

Two regularised linear classifiers judge the sentences of a page by hashed n-grams, length and title features: one
tells filler and unfilled slots, one tells messages of servers and browsers from content. They are fitted on a bounded
sample with weak labels: fixed phrases and shapes, the response status, and how much text stands around. Phrases label
the sample only; pages are judged by the classifiers alone. A page is a case where some sentence is filler, or where
messages outweigh content once furniture is set aside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import spread
from .layout import AT_ONCE, FIT_ROWS, HOST, Lines, sample
from .linear import Hasher, fit, scores
from .overlap import slices

# Shapes of slots that template languages leave behind.
NAME = r"[A-Za-z]+(?:[_.-][A-Za-z]+)*"
SLOT = re.compile(
    "|".join((
        rf"\{{\{{+\s*[\w.|$ {{-]+\s*\}}+", rf"(?<!\{{)\{{\s*{NAME}\s*\}}", rf"\$\{{\s*{NAME}\s*\}}", rf"\[\[\s*{NAME}\s*\]\]",
        r"\{%[^%\n]*%\}", r"<%[^%\n]*%>", r"<\?[^?\n]*\?>", r"%[A-Z]{2,}(?:_[A-Z]+)*%", r"__[A-Z]{2,}(?:_[A-Z]+)*__", r"\bXX_[A-Z_]+_XX\b",
        r"\*\|[A-Z_]+\|\*", r"@@[A-Z_]+@@", r"#[a-z]+(?:_[a-z]+)*#", r"\(undefined\s+\w+\)", r":[a-z]+(?:_[a-z]+)*: null\b",
        r"\bTODO:?\s+[a-z_]+", r"\[(?:Your|Ihr|Votre|Su) [\w ]+\]", r"\[\w+ (?:einfügen|here|ici|aquí|qui|hier)\]", r"\[(?:INSERT|ENTER) \w+\]",
        r"\[(?:[a-z]+_[a-z_]+)\]", r"&lt;\s*[a-z]+(?:_[a-z]+)*\s*&gt;", r"<(?!(?:p|b|i|u|a|br|hr|li|ul|ol|em|tt|td|tr|th|dl|dt|dd|div|pre|sub|sup|code|span|strong|small|table|body|html|head)\b)[a-z]+(?:_[a-z]+)*>",
        r"\[(?:price|owner|slogan|company|phone|city|address|date|name|title|text|email|url|image|logo|year|street|region|country)\]",
    ))
)
#: Signs of which every slot has one.
SIGNS = frozenset("{[<%_*@#(:&") | {"O"}
# Phrases of filler copy.
FILLER = re.compile(
    r"lorem ipsum|dolor sit amet|placeholder|edit this block|your text (?:goes )?here|sample (?:paragraph|text|page|heading)|dummy (?:text|paragraph)|"
    r"short title and a friendly|tell visitors why|describe your (?:company|business)|replace (?:it|this) with your|\basdf\b|\bqwer\b|"
    r"platzhalter|beispieltext|hier steht ihr|hier klicken, um|beschreiben sie hier|texte d'exemple|texte de remplacement|cliquez ici pour modifier|ajoutez ici|"
    r"texto de ejemplo|título de ejemplo|aquí para editar|texto de relleno|testo di prova|titolo di prova|clic qui per modificare|testo segnaposto|"
    r"voorbeeldtekst|klik hier om dit|vul hier|texto de exemplo|exempeltext|tekst przykładowy|just another|hello world"
)
# Phrases of messages of servers and browsers, and of notices that scripts are needed.
MESSAGE = re.compile(
    r"\b(?:error|erreur|fehler|errore|fout|status|http)\s*:?\s*[45]\d\d\b|\b[45]\d\d\s+(?:not found|forbidden|error|bad|internal|service|gone|unavailable)|not found\b|access denied|permission to open|"
    r"does not exist on|no longer available|cannot be displayed|temporarily down|down for maintenance|internal (?:server )?(?:error|failure)|bad gateway|sent no reply|did not respond|"
    r"must be logged in|exception was thrown|unknown to this server|moved or was deleted|failed to open stream|warning: include|\bon line \d+|line \d+, file|parent directory|index of /|stack trace|sign in again|storage is full|connection was reset|virtual host|could not be verified|account has been suspended|session has expired|block list|security rule|redirect loop|too many (?:visitors|requests)|you are human|fatal error|application error|"
    r"link you followed|record you want was removed|has not paid for|no page has been added|enable javascript|javascript is required|without javascript|requires? javascript|scripts? (?:appear|are switched|is) |"
    r"blocking scripts|switched off here|see a blank page|active scripting|scripting is disabled|js is turned off|noscript|allow scripts|stops the code of|does not execute code|browser is too old|single page application|loaded dynamically|"
    r"aktivieren sie javascript|ihr browser gerade sperrt|nicht gefunden|zugriff verweigert|wartungsarbeiten|wegen wartung|nicht erreichbar|serverproblem|ist abgelaufen|ein fehler aufgetreten|interner fehler|"
    r"activer javascript|votre navigateur bloque|introuvable\W*$|accès refusé|en maintenance, retour|problème interne|session a expiré|n'existe pas|"
    r"javascript para ver|navegador bloquea|no existe\W*$|acceso denegado|en mantenimiento, vuelva|error interno|sesión ha caducado|"
    r"javascript per vedere|browser blocca|non trovata|accesso negato|in manutenzione, torniamo|errore interno|sessione è scaduta|"
    r"javascript aan om|browser blokkeert|bestaat niet|toegang geweigerd|in onderhoud, terug|interne fout|sessie is verlopen"
)
SENTENCE = re.compile(r"(?<=[.!?…])\s+")
#: Features of a sentence besides its words; none of them asks for a phrase.
FLAGS = ("slot", "repeated word", "first line", "unended", "few words", "many words", "names a host", "digits only", "furniture")
#: Words of content from which a page of the sample is taken for a real one.
REAL = 60
#: Sentences of content in the sample that are fitted at most, evenly picked.
FIT_CONTENT = 30_000
#: Score of the message classifier under which a sentence is clearly content.
UNSURE = -1.5
#: Score of the filler classifier from which one sentence makes its page a case.
FILLED = 1.0


def _repeated(words: list[str]) -> bool:
    """The same few words again and again, as in `bla bla bla` or `asdf qwer asdf`."""
    return len(words) >= 4 and len(set(words)) * 3 <= len(words)


def sentences(text: str, furniture: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(sentences, flags) of a text whose furniture is told by line; hosts are written as `host`."""
    out, flags = [], []
    first = True
    for line, away in zip(text.split("\n"), furniture):
        line = line.strip()
        if not line:
            continue
        for s in SENTENCE.split(line):
            words = s.lower().split()
            if not words:
                continue
            slot = not SIGNS.isdisjoint(s) and bool(SLOT.search(s))
            host = "." in s[:-1] and bool(HOST.search(s))
            out.append(HOST.sub("host", s) if host else s)
            flags.append((slot, _repeated(words), first, s[-1] not in ".!?…", len(words) <= 4, len(words) >= 9, host, not any(c.isalpha() for c in s), away))
        first = False
    return out, np.array(flags, bool).reshape(len(out), len(FLAGS))


def weak_labels(flags: np.ndarray, texts: list[str], status: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(filler, message) labels of the sentences of one page of the sample: 1, 0, or -1 for unknown."""
    sizes = np.array([len(t.split()) for t in texts])
    low = [t.lower() for t in texts]
    fill, message = np.array([bool(FILLER.search(t)) for t in low], bool), np.array([bool(MESSAGE.search(t)) for t in low], bool)
    slot, repeat, away = flags[:, 0], flags[:, 1], flags[:, -1]
    marked = slot | fill | repeat
    told = slot | fill | message
    lorem = np.zeros(len(texts), bool)
    on = False
    for k, t in enumerate(low):
        on = on or "lorem ipsum" in t
        lorem[k] = on and not message[k]
    main = ~away | told  # furniture that no phrase names is neither
    filler = np.where(marked, 1, np.where((marked & main).any(), np.where(lorem & (sizes <= 14), 1, -1), 0))
    content = int(sizes[main & ~(marked | message)].sum())
    failed = status is not None and status not in ("success", "empty")
    if (message & main).any() and (content < 30 or failed and content < REAL):
        said = np.where(marked, -1, 1)
    elif content >= REAL:
        said = np.where(message | marked, -1, 0)
    else:
        said = np.where(message, 1, np.where(marked | failed, -1, 0))
    return np.where(main, filler, 0), np.where(main, said, 0)


class Model:
    """The two classifiers, and the one of lines that tells furniture; `judge` tells which texts are cases."""

    def __init__(self, lines: Lines | None = None) -> None:
        self.lines = lines or Lines()
        self.hasher = Hasher(bits=16, flags=len(FLAGS))
        self.weights: list[tuple[np.ndarray, float]] = []

    def fit(self, rows: list[tuple[str, str | None]]) -> Model:
        texts, flags, fillers, said = [], [], [], []
        for (text, status), away in zip(rows, self.lines.furniture([t for t, _ in rows])):
            s, f = sentences(text, away)
            if s:
                a, b = weak_labels(f, s, status)
                texts += s
                flags.append(f)
                fillers.append(a)
                said.append(b)
        all_flags = np.concatenate(flags) if flags else np.zeros((0, len(FLAGS)), bool)
        for found in (fillers, said):
            y = np.concatenate(found) if found else np.zeros(0, int)
            at = np.flatnonzero(y >= 0)
            many = at[y[at] == 0]
            at = np.sort(np.concatenate((at[y[at] == 1], many[:: 1 + len(many) // FIT_CONTENT])))
            self.weights.append(fit(self.hasher([texts[i] for i in at], all_flags[at]), y[at].astype(float), self.hasher.width))
        return self

    def scores(self, texts: list[str], flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        triples = self.hasher(texts, flags)
        filler, said = (scores(w, b, len(texts), triples) for w, b in self.weights)
        return filler, said

    def judge(self, pages: list[str], furniture: list[np.ndarray] | None = None) -> np.ndarray:
        """Which pages are cases; their furniture is told anew unless it is given."""
        furniture = self.lines.furniture(pages) if furniture is None else furniture
        return np.concatenate([np.zeros(0, bool), *(self._judge(pages[lo:hi], furniture[lo:hi]) for lo, hi in slices(pages, AT_ONCE))])

    def _judge(self, pages: list[str], furniture: list[np.ndarray]) -> np.ndarray:
        parts = [sentences(p, f) for p, f in zip(pages, furniture)]
        texts = [s for p in parts for s in p[0]]
        out = np.zeros(len(pages), bool)
        if not texts:
            return out
        filler, said = self.scores(texts, np.concatenate([p[1] for p in parts]))
        at = 0
        for k, (s, f) in enumerate(parts):
            n, away = len(s), f[:, -1]
            size = np.array([len(t.split()) for t in s])
            fill, msg = filler[at : at + n] > FILLED, said[at : at + n] > 0
            plain = said[at : at + n] < UNSURE  # what is neither a message nor clearly content weighs for neither
            at += n
            words_said = int(size[msg & ~fill].sum())
            apart = int(size[msg & ~fill & ~away].sum())  # a notice among furniture is no match for real content
            real = plain & ~fill & ~away
            content = int(size[real].sum())
            prose = bool((real & (size >= 6)).any())
            out[k] = bool(n and (fill.any() or words_said and (apart >= content or not prose) or not (plain | away).any()))
        return out


def fitted(df: DataFrame, id_col: str = "page_id", text_col: str = "website_text", status_col: str = "website_text_status", most: int = FIT_ROWS) -> Model:
    """All classifiers, fitted on one bounded sample of rows."""
    rows = sample(df, id_col, text_col, status_col, most)
    return Model(Lines().fit([t for t, s in rows if s == "success"])).fit(rows)


def _pick(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            case = model.judge(b.column("text").to_pylist())
            yield pa.record_batch({"id": b.column("id").filter(pa.array(case))})

    return run


def residue_pages(df: DataFrame, id_col: str = "page_id", text_col: str = "website_text", status_col: str = "website_text_status", model: Model | None = None) -> DataFrame:
    """(id): rows of status `success` whose text is a template, filler, a message or a notice instead of content.

    Null ids, texts or statuses, and texts without words, are no case; repeated rows come out repeated; an empty table
    gives an empty result. The fit sees a bounded sample, the judgement all rows; nothing is shuffled.
    """
    model = model or fitted(df, id_col, text_col, status_col)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(status_col).alias("s")).where("id is not null and text is not null and s = 'success'")
    return spread(rows.select("id", "text")).mapInArrow(_pick(model), "id long").withColumnRenamed("id", id_col)

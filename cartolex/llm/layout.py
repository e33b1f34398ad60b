"""Problem 7: the main body of pages whose text is mixed with page furniture.

HTML goes through a tree builder with implied tags and visibility rules, which emits visible text with block spacing,
list marks and aligned table cells. Text that is already rendered is read back into that layout: blocks between blank
lines, rows of cells, list items, trails. A regularised linear classifier then judges every line by its layout and that of
its neighbours and by hashed n-grams. It is fitted on a bounded sample of texts whose lines are labelled weakly, by shapes
and fixed phrases of notices; the phrases label the sample only and judge no line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import spread
from .linear import Hasher, fit, scores
from .overlap import slices

# --- HTML -------------------------------------------------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style title noscript template head svg iframe object select option".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Opening one of these ends an open one of those (implied end tags).
IMPLIED = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}, "option": {"option"},
    **{k: {"p"} for k in BLOCK - {"li", "dt", "dd", "tr", "td", "th", "tbody", "tfoot", "body", "html"}},
}
SCOPE = frozenset("ul ol dl table body html div section article".split())


class _Tree(HTMLParser):
    """Builds (tag, hidden, children) nodes; ends tags that are implied, ignores stray ones."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root: tuple[str, bool, list] = ("html", False, [])
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in IMPLIED.get(tag, ()):
                del self.open[k:]
            elif self.open[k][0] in SCOPE:
                break
        a = {k: (v or "") for k, v in attrs}
        style = a.get("style", "").replace(" ", "").lower()
        hidden = tag in HIDDEN or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
        node = (tag, hidden, [])
        self.open[-1][2].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1][0] == tag:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1][2].append(data)


def render(html: str) -> str:
    """Visible text of a page: a line per block, blank lines between paragraphs, `* ` before items, table cells aligned."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    lines: list[str] = [""]

    def fresh(blank: bool = False) -> None:
        if lines[-1].strip():
            lines.append("")
        if blank and len(lines) > 1 and lines[-2].strip():
            lines.append("")

    def plain(node) -> str:
        if isinstance(node, str):
            return node
        return "" if node[1] else " ".join(plain(c) for c in node[2])

    def rows(node) -> Iterator[list[str]]:
        for c in node[2]:
            if isinstance(c, str) or c[1]:
                continue
            if c[0] == "tr":
                yield [" ".join(plain(x).split()) for x in c[2] if not isinstance(x, str) and x[0] in ("td", "th") and not x[1]]
            elif c[0] != "table":
                yield from rows(c)

    # An explicit stack: pages may be nested deeper than Python recurses.
    todo: list[tuple[str, object]] = [("node", tree.root)]
    while todo:
        what, node = todo.pop()
        if what == "break":
            fresh(bool(node))
        elif isinstance(node, str):
            text = re.sub(r"\s+", " ", node)
            lines[-1] += text if lines[-1] or text.strip() else ""
        elif node[1]:
            continue
        elif node[0] == "br":
            lines.append("")
        elif node[0] == "table":
            fresh(True)
            table = [r for r in rows(node) if any(r)]
            wide = [max((len(r[k]) for r in table if k < len(r)), default=0) for k in range(max(map(len, table), default=0))]
            for r in table:
                lines[-1] = "  ".join(c.ljust(wide[k]) for k, c in enumerate(r)).rstrip()
                lines.append("")
            fresh(True)
        else:
            apart = node[0] in ("p", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre")
            if node[0] in BLOCK:
                fresh(apart)
                todo.append(("break", apart))
            if node[0] == "li":
                lines[-1] = "* "
            todo += [("node", c) for c in reversed(node[2])]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x.strip() for x in lines)).strip("\n")


# --- rendered lines ---------------------------------------------------------------------------------------------

# Entries of site menus in the languages of the pages.
MENU = {
    "en": "News|Home|Map|FAQ|Events|Gallery|Shop|Press|Prices|Login|Jobs|Search|Contact|Membership|About us|How to find us|Opening times|Photos|Videos|Links|Sitemap|Imprint|Privacy|Help",
    "de": "Aktuelles|Startseite|Karte|Termine|Bilder|Laden|Presse|Preise|Anmelden|Stellen|Suche|Kontakt|Mitglied werden|Über uns|Anfahrt|Öffnungszeiten|Impressum|Datenschutz|Hilfe",
    "fr": "Actualités|Accueil|Plan|Agenda|Photos|Boutique|Presse|Tarifs|Connexion|Emplois|Recherche|Contact|Adhérer|Qui sommes-nous|Venir chez nous|Horaires|Aide",
    "es": "Noticias|Inicio|Mapa|Agenda|Fotos|Tienda|Prensa|Precios|Acceder|Empleo|Buscar|Contacto|Hazte socio|Quiénes somos|Cómo llegar|Horarios|Ayuda",
    "it": "Notizie|Pagina iniziale|Mappa|Eventi|Foto|Negozio|Stampa|Prezzi|Accedi|Lavora con noi|Cerca|Contatti|Diventa socio|Chi siamo|Come arrivare|Orari|Aiuto",
    "nl": "Nieuws|Voorpagina|Kaart|Agenda|Foto's|Winkel|Pers|Prijzen|Inloggen|Vacatures|Zoeken|Contact|Lid worden|Over ons|Route|Openingstijden|Hulp",
    "pt": "Notícias|Início|Mapa|Agenda|Fotos|Loja|Imprensa|Preços|Entrar|Empregos|Pesquisa|Contacto|Quem somos|Como chegar|Horários|Ajuda",
    "sv": "Nyheter|Hem|Karta|Evenemang|Bilder|Butik|Press|Priser|Logga in|Jobb|Sök|Kontakt|Bli medlem|Om oss|Hitta hit|Öppettider|Hjälp",
    "pl": "Aktualności|Strona główna|Mapa|Wydarzenia|Galeria|Sklep|Prasa|Ceny|Zaloguj|Praca|Szukaj|Kontakt|O nas|Dojazd|Godziny otwarcia|Pomoc",
}
# Phrases by which notices, teasers, sharing lines, adverts and footers are known.
PHRASES = {
    "en": r"all rights reserved|site made by|registered in .+ under no|imprint \||legal notice|terms of use|data protection|we use cookies|may set\. settings|measure visits with cookies|stores small files on your device|your privacy matters: choose|you may also like|popular this week|^latest news\b|^related\b|follow us on|share this page|newsletter|may not be copied without|skip to main content|toggle navigation|back to top|previous page|next page|^read more$|^advertisement$|^sponsored$|close this window|you are here:|box could not be loaded|switch on scripts|allow scripts in your browser|unavailable in your country|best viewed|print this page",
    "de": r"alle rechte vorbehalten|^umsetzung:|eingetragen in .+ unter nr|impressum \||barrierefreiheit|datenschutz|verwenden cookies|cookie-einstellungen|speichert kleine dateien|privatsphäre ist uns wichtig: |könnte sie auch interessieren|^diese woche|^neueste meldung|^auch interessant|^siehe auch|folgen sie uns|seite teilen|rundbrief|verlinkter seiten|zum inhalt springen|menü öffnen|^nach oben$|vorige seite|nächste seite|^weiterlesen$|^anzeige$|fenster schließen|sie sind hier:|nicht geladen werden|skripte (ein|zu)|^mehr (dazu|lesen)",
    "fr": r"tous droits réservés|^réalisation :|inscrit à .+ sous le n|mentions légales|accessibilité ·|données personnelles|utilisons des cookies|choix de confidentialité|enregistre de petits fichiers|^à voir aussi|^cette semaine|^dernière nouvelle|^à lire\b|suivez-nous|^partager\b|lettre d'information|repris sans accord|aller au contenu|ouvrir le menu|haut de page|page précédente|page suivante|^lire la suite$|^publicité$|fermer (cette|la) fenêtre|vous êtes ici|n'a pas pu être charg|activez les scripts",
    "es": r"todos los derechos reservados|^diseño: taller|inscrito en .+ con el n|aviso legal|usamos cookies|configure las cookies|guarda pequeños archivos|le puede gustar|^lo más leído|^última noticia|^lea también|^relacionado|^ver también|síganos|^compartir\b|boletín|no pueden? (copiarse|reproducirse)|saltar al contenido|abrir menú|^volver arriba$|página anterior|página siguiente|^leer más$|^publicidad$|cerrar (esta|la) ventana|^está en: |no se pudo cargar|active los scripts",
    "it": r"tutti i diritti riservati|^realizzato da|iscritto a .+ con il n|note legali|usiamo i cookie|scelga i cookie|salva piccoli file|piacerti anche|^i più letti|^ultima notizia|^correlati|^leggi anche|^vedi anche|seguiteci|seguici|^condividi\b|lettera di notizie|senza (il )?consenso|vai al contenuto|aprire il menu|apri il menu|^torna su$|pagina precedente|pagina successiva|^leggi tutto$|^pubblicità$|chiudi (questa|la) finestra|^sei qui: |non è stato caricato|attivi gli script",
    "nl": r"alle rechten voorbehouden|^gebouwd door|ingeschreven te .+ onder nr|^colofon|gebruiken cookies|kies welke cookies|bewaart kleine bestanden|misschien ook leuk|^deze week|^laatste nieuws|^zie ook|^lees ook|volg ons|deel deze pagina|nieuwsbrief|zonder (schriftelijke )?toestemming|naar de inhoud|menu openen|^naar boven$|vorige pagina|volgende pagina|^lees verder$|^advertentie$|sluit dit venster|u bent hier:|kon niet worden geladen|zet scripts aan",
    "pt": r"todos os direitos reservados|aviso legal|usamos cookies|também pode gostar|^leia também|siga-nos|^partilhar|boletim informativo|saltar para o conteúdo|voltar ao topo|página seguinte|^ler mais$|^publicidade$|está em: ",
    "sv": r"alla rättigheter förbehållna|vi använder (cookies|kakor)|du kanske också gillar|^läs också|följ oss|dela sidan|nyhetsbrev|hoppa till innehåll|till toppen|nästa sida|^läs mer$|^annons$|du är här:",
    "pl": r"wszelkie prawa zastrzeżone|używamy (plików )?cookies|może ci się spodobać|^zobacz też|śledź nas|udostępnij|newsletter|przejdź do treści|do góry|następna strona|^czytaj więcej$|^reklama$|jesteś tutaj:",
}
HOST = re.compile(r"\b(?:[a-z0-9-]+\.)+(?:example|com|org|net|info|eu|de|fr|es|it|nl|pl|se|pt|ru|jp|uk)\b", re.I)
PHRASE = re.compile("|".join(PHRASES.values()))
SHORT_LINE = 26
ENTRIES = frozenset(x.lower() for v in MENU.values() for x in v.split("|"))
CELLS = re.compile(r"\s+[|»·•/]\s+|\s{2,}|\t+")
#: A text cut off: an ellipsis at the end, bare or before a link word.
CUT = re.compile(r"(?:\.\.\.|…)\s*(?:\[\w+\]|[>»]*\s*\w{2,12})?\s*$")
BULLET = re.compile(r"^\s*[*•–-]\s+")
COPYRIGHT = re.compile(r"^\s*(?:©|\(c\)|copyright\b)", re.I)
ENDED = re.compile(r"[.!?。:;,…]\s*$")


def _entry(cell: str) -> bool:
    return cell.strip().lower() in ENTRIES


def _short(cell: str) -> bool:
    cell = cell.strip()
    return 0 < len(cell) <= 40 and len(cell.split()) <= 5 and not any(c.isdigit() for c in cell) and not ENDED.search(cell)


@lru_cache(maxsize=100_000)
def _notice(x: str) -> bool:
    """An entry, a text cut off, or a line of at most SHORT_LINE words that names a host or has a phrase of notices."""
    if _entry(x) or CUT.search(x) or COPYRIGHT.search(x):
        return True
    return len(x.split()) <= SHORT_LINE and bool(HOST.search(x) or PHRASE.search(x.lower()))


def weak_furniture(text: str) -> list[bool]:
    """Weak labels of a text's lines (split at line feeds), by shapes and phrases: whether they are furniture. Blank lines are not."""
    lines = text.split("\n")
    bare = [BULLET.sub("", x).strip() for x in lines]
    out = []
    for raw, x in zip(lines, bare):
        if not x:
            out.append(False)
            continue
        cells = [c for c in CELLS.split(raw.strip()) if c.strip()]
        row = len(cells) >= 2 and all(map(_short, cells))
        trail = x.count(" > ") >= 2
        out.append(bool(row or trail or _notice(x)))
    # A run of three or more short list items or entries, blank lines aside, is a menu.
    filled = [k for k, x in enumerate(bare) if x]
    k = 0
    while k < len(filled):
        end = k
        while end < len(filled) and _short(bare[filled[end]]) and (BULLET.match(lines[filled[end]]) or out[filled[end]]):
            end += 1
        if end - k >= 3:
            for j in filled[k:end]:
                out[j] = True
        k = max(end, k + 1)
    return out


FLAGS = (
    "row of cells", "cells", "trail", "list item", "short", "in a run of items", "ended", "cut off", "copyright", "names a host", "1 or 2 words", "to 6 words", "to 14 words", "more words",
    "blank before", "blank after", "short before", "short after", "first lines", "last lines",
)
#: Rows that the classifier of lines is fitted on at most.
FIT_ROWS = 4_000
#: Characters of text whose features are held at once.
AT_ONCE = 1_000_000


def layout_of(text: str) -> tuple[list[int], list[str], np.ndarray]:
    """(line numbers, lines, flags) of the lines of a text that are not blank; hosts are written as `host`."""
    lines = text.split("\n")
    bare = [BULLET.sub("", x).strip() for x in lines]
    filled = [k for k, x in enumerate(bare) if x]
    n = len(filled)
    short = [_short(bare[k]) for k in filled]
    cells = [[c for c in CELLS.split(lines[k].strip()) if c.strip()] for k in filled]
    row = [len(c) >= 2 and all(map(_short, c)) for c in cells]
    item = [bool(BULLET.match(lines[k])) for k in filled]
    run, i = [False] * n, 0
    while i < n:
        end = i
        while end < n and short[end] and (item[end] or row[end]):
            end += 1
        if end - i >= 3:
            run[i:end] = [True] * (end - i)
        i = max(end, i + 1)
    flags, out = np.zeros((n, len(FLAGS)), bool), []
    for p, k in enumerate(filled):
        x = bare[k]
        words = x.count(" ") + 1
        host = "." in x and bool(HOST.search(x))
        flags[p] = (
            row[p], len(cells[p]) >= 2, x.count(" > ") >= 2, item[p], short[p], run[p], bool(ENDED.search(x)), bool(CUT.search(x)), bool(COPYRIGHT.search(x)), host,
            words <= 2, 3 <= words <= 6, 7 <= words <= 14, words > 14, k == 0 or not bare[k - 1], k + 1 == len(bare) or not bare[k + 1], p > 0 and short[p - 1], p + 1 < n and short[p + 1], p < 2, p >= n - 3,
        )
        out.append(HOST.sub("host", x) if host else x)
    return filled, out, flags


class Lines:
    """The classifier of lines; `furniture` judges whole texts."""

    def __init__(self) -> None:
        self.hasher = Hasher(bits=18, flags=len(FLAGS))
        self.weights, self.bias = np.zeros(self.hasher.width, np.float32), -1.0

    def fit(self, texts: list[str]) -> Lines:
        parts = [layout_of(t) for t in texts]
        y = [np.array(weak_furniture(t), bool)[p[0]] for t, p in zip(texts, parts) if p[0]]
        if y:
            lines, labels = [x for p in parts for x in p[1]], np.concatenate(y).astype(float)
            w, self.bias = fit(self.hasher(lines, np.concatenate([p[2] for p in parts if p[0]])), labels, self.hasher.width)
            self.weights = w.astype(np.float32)
        return self

    def furniture(self, texts: list[str]) -> list[np.ndarray]:
        """Of each line of each text (split at line feeds): whether it is page furniture. Blank lines are not."""
        return [x for lo, hi in slices(texts, AT_ONCE) for x in self._furniture(texts[lo:hi])]

    def _furniture(self, texts: list[str]) -> list[np.ndarray]:
        parts = [layout_of(t) for t in texts]
        lines = [x for p in parts for x in p[1]]
        score = scores(self.weights, self.bias, len(lines), self.hasher(lines, np.concatenate([p[2] for p in parts]))) if lines else np.zeros(0)
        out, at = [], 0
        for t, (filled, _, _) in zip(texts, parts):
            mine = np.zeros(t.count("\n") + 1, bool)
            mine[filled] = score[at : at + len(filled)] > 0
            at += len(filled)
            out.append(mine)
        return out


def sample(df: DataFrame, id_col: str, text_col: str, status_col: str, most: int = FIT_ROWS) -> list[tuple[str, str | None]]:
    """(text, status) of the `most` rows of smallest hashed id: a bounded sample that does not depend on how the table is stored."""
    known = df.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text"), F.col(status_col).alias("status"))
    # Few more rows than wanted pass a cut of the hash, so that tasks send the driver little beyond the sample.
    share = min(1.0, 1.5 * most / max(1, known.count()))
    cut = int(-(1 << 63) + share * ((1 << 64) - 1))
    rows = known.where(F.col("h") <= min(cut, (1 << 63) - 1)).orderBy("h", "text").limit(most).collect()
    return [(r["text"], r["status"]) for r in rows]


def fitted(df: DataFrame, id_col: str = "page_id", text_col: str = "website_text", status_col: str = "website_text_status", most: int = FIT_ROWS) -> Lines:
    """The classifier of lines, fitted on the sampled texts of status `success`."""
    return Lines().fit([t for t, s in sample(df, id_col, text_col, status_col, most) if s == "success"])


MARKUP = re.compile(r"<(?:p|div|li|body|table|br)\b", re.I)


def rendered(text: str) -> str:
    """A text as it is, or what its mark-up shows."""
    return render(text) if "</" in text and MARKUP.search(text) else text


def body_of(text: str, away: np.ndarray) -> str:
    """The lines that are not furniture, block spacing kept, no blank line twice."""
    kept = "\n".join(x.rstrip() for x, f in zip(text.split("\n"), away) if not f)
    return re.sub(r"\n{3,}", "\n\n", kept).strip("\n")


def _find(lines: Lines, skip: object | None):
    """Rows (page_id, col_name, line_no); with `skip` texts of the first column that it judges to be no page at all have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages, cols, texts = (b.column(c).to_pylist() for c in ("page", "col", "text"))
            marks = lines.furniture(texts)
            if skip is not None:
                at = [k for k, c in enumerate(cols) if c == COLUMNS[0][0]]
                for k, case in zip(at, skip.judge([texts[k] for k in at], [marks[k] for k in at])):
                    if case:
                        marks[k] = marks[k][:0]
            nos = [np.flatnonzero(m) for m in marks]
            who = np.repeat(np.arange(len(texts)), [len(x) for x in nos])
            rows = pa.array(who, pa.int64())
            yield pa.record_batch({"page_id": b.column("page").take(rows), "col_name": b.column("col").take(rows), "line_no": pa.array(np.concatenate(nos) if nos else [], pa.int64())})

    return run


def _texts(df: DataFrame, id_col: str, columns: tuple[tuple[str, str], ...]) -> DataFrame:
    """(page, col, text): one row per text of status success."""
    pairs = F.array(*[F.struct(F.lit(t).alias("col"), F.col(t).alias("text"), F.col(s).alias("status")) for t, s in columns])
    rows = df.select(F.col(id_col).cast("long").alias("page"), F.explode(pairs).alias("x")).select("page", "x.*")
    return rows.where("page is not null and status = 'success' and text is not null")


COLUMNS = (("website_text", "website_text_status"), ("contact_website_text", "contact_website_text_status"))


def furniture_lines(df: DataFrame, lines: Lines, id_col: str = "page_id", columns: tuple[tuple[str, str], ...] = COLUMNS, skip: object | None = None) -> DataFrame:
    """(page_id, col_name, line_no) of every line that is page furniture, in texts whose status is `success`.

    With `skip`, a judge of pages, texts of the first column that it takes for no page have no row; it is asked in the same
    pass. Null ids, texts and statuses give no row; a text without lines, or an empty table, gives none; repeated rows give
    repeated lines. One pass, no shuffle.
    """
    return spread(_texts(df, id_col, columns).select("page", "col", "text")).mapInArrow(_find(lines, skip), "page_id long, col_name string, line_no long")


def _bodies(lines: Lines):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [rendered(t) for t in b.column("text").to_pylist()]
            bodies = [body_of(t, m) for t, m in zip(texts, lines.furniture(texts))]
            yield pa.record_batch({"page_id": b.column("page"), "col_name": b.column("col"), "body": pa.array(bodies, pa.string())})

    return run


def bodies(df: DataFrame, lines: Lines, id_col: str = "page_id", columns: tuple[tuple[str, str], ...] = COLUMNS) -> DataFrame:
    """(page_id, col_name, body): the main body of every text of status `success`; '' where there is none. HTML is rendered first."""
    return spread(_texts(df, id_col, columns).select("page", "col", "text")).mapInArrow(_bodies(lines), "page_id long, col_name string, body string")

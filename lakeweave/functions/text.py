"""Text functions: Column to Column, all of them built-in expressions (no Python in the tasks).

Java's ``\\s \\w \\b`` are ASCII and its ``(?i)`` folds ASCII only; patterns that must see Cyrillic say ``(?U)``
or ``(?iu)``. Ratios go through ``try_divide``, since ANSI mode raises on a zero divisor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: patterns and word lists that decide results. -------------------------------------------

NORMATIVE = r"^\s*((\d+(\.\d+){0,4})|([A-Za-zА-Яа-я]\))|([IVXLCMivxlcm]+\.))\s+"
SECTION_START = r"^\s*((Раздел|Section|Глава)\s+\d+|\d+(\.\d+)*\s+[A-Za-zА-Яа-я])"
NUMBERED = r"^\s*(\d+(?:\.\d+){0,4})\s+(.+)$"
CODE_LINE = r"^[A-ZА-ЯЁ]{1,4}[-\s]?\d{2,6}([-/][A-ZА-ЯЁ0-9]+)?$"
NUMERIC_LINE = r"^[\d\s.,xXхХ\-–+/%°\"']+$"
TABLE_HINTS = ("артикул", "внутренние размеры", "внешние размеры", "размер ниши", "количество в упаковке", "шт.", "мм", "d1", "d2", "b1", "b2")
TABLE_WORDS = ("наименование", "ед.", "кол-во", "qty", "unit", "amount")
STANDARD_ID = r"(?iu)(?:ГОСТ(?:\s+Р)?|GOST(?:\s+R)?|СНиП|SNIP|IEC|ISO)\s*\d[\d.\-/–— ]{0,25}\d|(?U:\b)(?:СП|ФЗ)\s+\d[\d.\-/–— ]{0,25}\d"
YEAR = r"(?U)\b(19\d{2}|20[0-3]\d)\b"
VENDORS = {"ABB": ("abb",), "Schneider": ("schneider", "se ", "шнайдер"), "Legrand": ("legrand", "легран"), "IEK": ("iek", "иэк"), "EKF": ("ekf",), "Hager": ("hager",), "DKC": ("dkc", "дкс")}
FIRE_WORDS = ("пожар", "огнестой", "пожарн", "fire", "flame")
NORM_WORDS = ("гост", "сп ", "снип", "пуэ", "пэу", "норматив", "стандарт", "regulation")
CATALOG_WORDS = ("каталог", "catalog", "datasheet", "технический каталог")
KNOWN_EXTENSIONS = ("pdf", "docx", "xlsx", "html", "htm", "xml")
STOPWORDS = (
    "для", "при", "как", "что", "или", "это", "его", "еще", "ещё", "можно", "нужно", "когда", "какой", "какая", "какие", "где",
    "есть", "быть", "если", "ли", "по", "из", "на", "все", "всё", "the", "and", "for", "with", "from",
)
METADATA_WORDS = ("итого", "всего", "подитог", "субподряд", "заказчик", "подрядчик", "исполнитель", "генподрядчик", "субподрядчик")
METADATA_PATTERNS = (
    r"(?iu)(?:ИНН|ОГРН|КПП|БИК)\s*:?\s*\d",
    r"(?iu)(?:ООО|ОАО|ЗАО|ПАО|АО)\s+[«\"]",
    r"(?iu)(?:ИТОГО|ВСЕГО|итого)\s*(?:по|:|\s*$)",
    r"(?iu)(?:тел|факс|телефон|e-?mail)\s*[:/]",
    r"(?iu)(?:подпись|дата|М\.П\.|печать)",
)
OFFICE_PATTERNS = (
    r"(?iu)(?:ОФИС В|офис в)\s+[А-ЯA-Z]",
    r"(?ius)(?:ЛАТВИЯ|УЗБЕКИСТАН|МОНГОЛИЯ|ГРУЗИЯ|КАЗАХСТАН|БЕЛАРУСЬ|МОЛДОВА|КЫРГЫЗСТАН).*(?:тел|tel|факс|fax|@)",
)
NOISE_RULES = (
    ("phone", r"(?:\+7|8)\s*\(?\d{3}\)?[\s\-]*\d{3}[\s\-]*\d{2}[\s\-]*\d{2}", 2.0),
    ("address", r"(?iu)(?:г\.|ул\.|д\.|офис|корп|стр\.|пр-т|пер\.)", 2.0),
    ("url", r"(?iU)https?://|www\.|@\w+\.\w+", 1.5),
    ("legal", r"(?iu)(?:ООО|ОАО|ЗАО|ПАО|АО|ИП|ИНН|ОГРН|КПП)", 2.0),
    ("marketing", r"(?iu)(?:скидк|акци|распродаж|бесплатн|звоните)", 1.5),
    ("toc", r"(?iu)\.{5,}|содержание|оглавление", 1.0),
    ("copyright", r"(?iu)©|copyright|все права", 1.5),
    ("page_number", r"^\s*\d{1,3}\s*$", 1.0),
)
VALUE_RULES = (
    ("article_code", r"(?iu)[А-ЯA-Z]{2,}\d*[-\s]?\d+[хxХX×]\d+", 2.0),
    ("spec_value", r"(?iu)\d+[\.,]?\d*\s*(?:мм²?|кВА?|IP\d{2}|°[CС]|кВт|А|В|Ом|кг|м[²³]?)", 2.0),
    ("product_name", r"(?iu)(?:кабель|провод|контактор|автомат|выключател|трансформатор|УЗО|АВДТ|стабилизатор|щит)", 2.0),
    ("gost_ref", r"(?iu)ГОСТ\s*[\d\.]+", 1.5),
    ("rating", r"(?iu)[UIР]=\s*\d+", 1.5),
)
ROW_CODES = (r"\d{2}\.\d+\.\d+\.\d+-\d+", r"\d{2}-\d{2}-\d{3}-\d+", r"КП\s*№?\d+", r"\d{3}-\d{4}")
ROW_UNITS = r"(?iu)(мм|mm|м2|м3|м|m|кг|kg|шт|pcs|т|компл|пог\.\s*м|п\.м|куб\.\s*м|л|усл\.\s*ед|маш\.\s*час|чел\.\s*час|кВт|kW|МПа|Па|1000\s*шт)"
HIGH_VALUE_FIELDS = ("name", "code", "наименование", "обоснование", "шифр")
REVERSED_STARTS = ("яансап", "яачобар", "еиксеч", "еыньлет", "яинедев", "еоньлау", "ЕИКСЕЧ", "ЕЫНЬЛЕТ", "ЯАНСАП")
NORMAL_STARTS = ("безопас", "рабоча", "техниче", "дополнит", "введени", "удальн", "БЕЗОПАС", "ТЕХНИЧЕ", "ДОПОЛНИТ")
SOURCE_BY_EXTENSION = {"txt": "text", "htm": "html", "html": "html", "xhtml": "html", "markdown": "markdown", "md": "markdown", "xml": "xml", "pdf": "pdf", "docx": "docx", "xlsx": "xlsx"}
SOURCE_BY_MEDIA_TYPE = {
    "text/plain": "text", "text/markdown": "markdown", "text/html": "html", "application/xhtml+xml": "html", "application/xml": "xml", "text/xml": "xml", "application/pdf": "pdf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
}

#: Characters of a token, by estimate.
CHARS_PER_TOKEN = 4


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_of(tests) -> Column:
    return reduce(lambda a, b: a | b, tests)


def has_any(text: Column, words) -> Column:
    return any_of([text.contains(w) for w in words])


def strip(c: Column | str) -> Column:
    """Trim white space of any kind (trim() drops spaces only)."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def normalize_text(c: Column | str) -> Column:
    """B1: no carriage returns, at most one empty line, single spaces, stripped."""
    c = F.replace(F.coalesce(col(c), F.lit("")), F.lit("\r"), F.lit(""))
    return strip(F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"[ \t]+", " "))


def paragraphs(c: Column | str) -> Column:
    """B2: parts between empty lines, stripped, none empty."""
    return F.filter(F.transform(F.split(col(c), r"(?U)\n\s*\n"), strip), lambda p: p != "")


def lines(c: Column | str) -> Column:
    """Stripped lines that aren't empty."""
    return F.filter(F.transform(F.split(col(c), r"\R"), strip), lambda p: p != "")


def first_line(c: Column | str) -> Column:
    return strip(F.element_at(F.split(strip(c), r"\R"), 1))


def count_tokens(c: Column | str) -> Column:
    """Estimated tokens, a quarter of the stripped characters and at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(strip(c)) / CHARS_PER_TOKEN)).cast("int")


def count_chars(c: Column, char_class: str) -> Column:
    """Characters of a class: what their removal shortens (faster than counting matches)."""
    return F.length(c) - F.length(F.regexp_replace(c, f"{char_class}+", ""))


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _count(array: Column, test) -> Column:
    return F.size(F.filter(array, test))


def let(value: Column, body) -> Column:
    """body(value), where value is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_table_like(c: Column | str) -> Column:
    """Pipes, tabs, column gaps, hint words, codes, numbers and short lines; fewer than two lines are looked at no further."""
    c = col(c)

    def counted(ls: Column) -> Column:
        gaps = _count(ls, lambda x: x.rlike(r"(?U)\S\s{2,}\S"))
        codes = _count(ls, lambda x: x.rlike(CODE_LINE))
        numeric = _count(ls, lambda x: x.rlike(r"\d") & (x.rlike(NUMERIC_LINE) | (F.size(F.split(x, r"(?U)\s+")) <= 3)))
        short = _count(ls, lambda x: F.length(x) <= 18)
        return F.struct(F.size(ls).alias("n"), gaps.alias("gaps"), codes.alias("codes"), numeric.alias("numeric"), short.alias("short"), F.lower(c).alias("low"))

    def judged(s: Column) -> Column:
        n, gaps, codes, numeric, low = s["n"], s["gaps"], s["codes"], s["numeric"], s["low"]
        found = (gaps >= 3) & (n >= 4)
        found |= (codes >= 3) & (numeric >= 3)
        found |= (n >= 8) & (s["short"] >= 0.65 * n) & (codes + numeric >= 5)
        found |= (gaps >= 2) & has_any(low, TABLE_WORDS)
        found |= ((numeric >= 3) | (codes >= 2)) & has_any(low, TABLE_HINTS)
        return found

    def table(ls: Column) -> Column:
        marked = (_count(ls, lambda x: x.contains("|")) >= 2) | (_count(ls, lambda x: x.contains("\t")) >= 2)
        return F.when(F.size(ls) < 2, False).otherwise(marked | let(counted(ls), judged))

    return F.coalesce(let(lines(c), table), F.lit(False))


def is_normative(c: Column | str) -> Column:
    """The first line begins with 1.2, a) or IV."""
    return F.coalesce(F.concat(first_line(c), F.lit("")).rlike(NORMATIVE), F.lit(False))


def is_upper(c: Column) -> Column:
    """Has a cased letter, and none of lower case."""
    return c.rlike(r"[\p{Lu}\p{Lt}]") & ~c.rlike(r"[\p{Ll}\p{Lt}]")


def section_heading(c: Column | str) -> Column:
    """struct(heading, level), null if the first line is no heading."""
    heading = lambda h, n: F.struct(h.alias("heading"), n.cast("int").alias("level"))

    def judged(s: Column) -> Column:
        line, number, title = s["line"], s["number"], s["title"]
        level = F.least(F.lit(5), F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1)
        return (
            F.when((number != "") & (title != ""), heading(F.concat(number, F.lit(" "), title), level))
            .when(line.rlike(SECTION_START), heading(line, F.lit(1)))
            .when((F.length(line) <= 80) & is_upper(line), heading(line, F.lit(1)))
        )

    parts = lambda line: F.struct(line.alias("line"), F.regexp_extract(line, NUMBERED, 1).alias("number"), strip(F.regexp_extract(line, NUMBERED, 2)).alias("title"))
    return let(first_line(c), lambda line: F.when(F.length(line) > 140, None).otherwise(let(parts(line), judged)))


def classify_block(c: Column | str) -> Column:
    """Table and normative labels, or normal."""
    label = lambda test, name: F.when(test, F.lit(name))
    labels = lambda s: F.array_compact(F.array(label(s["t"], "table"), label(s["n"], "normative"), label(~s["t"] & ~s["n"], "normal")))
    return let(F.struct(is_table_like(c).alias("t"), is_normative(c).alias("n")), labels)


def cid_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\(cid:\d+\)"))


def is_cid_garbage(c: Column | str) -> Column:
    """Over five glyph codes that make over 15 % of the text."""
    c = col(c)
    return (F.length(c) >= 50) & (cid_count(c) > 5) & (10 * cid_count(c) > 0.15 * F.length(c))


def script_language(c: Column | str) -> Column:
    """By script: mixed, ru, en or unknown."""
    c = col(c)
    cyrillic, latin = c.rlike("[А-Яа-яЁё]"), c.rlike("[A-Za-z]")
    return F.when(cyrillic & latin, "mixed").when(cyrillic, "ru").when(latin, "en").otherwise("unknown")


def extension(c: Column) -> Column:
    """Lower-case extension of a path's last part, empty if none."""
    base = F.element_at(F.split(F.coalesce(c, F.lit("")), "/"), -1)
    return F.lower(F.regexp_extract(base, r"[^.].*\.([^.]*)$", 1))


def infer_metadata(text: Column | str, document: Column | None = None, section: Column | None = None) -> Column:
    """struct(doc_type, vendor, standard_id, year, lang, source_type)."""
    blank = F.lit("")
    document = F.coalesce(document, blank) if document is not None else blank
    section = F.coalesce(section, blank) if section is not None else blank
    probe = F.concat(document, F.lit("\n"), section, F.lit("\n"), F.substring(F.coalesce(col(text), blank), 1, 2000))
    low = F.lower(probe)
    vendor = F.coalesce(*(F.when(has_any(low, aliases), F.lit(name)) for name, aliases in VENDORS.items()), blank)
    standard = F.regexp_replace(F.regexp_replace(F.regexp_extract(probe, STANDARD_ID, 0), r"(?U)\s+", " "), r"^[ .,:;]+|[ .,:;]+$", "")
    year = F.regexp_extract(F.when(standard != "", standard).otherwise(probe), YEAR, 1)
    kind = F.when(has_any(low, FIRE_WORDS), "fire").when((standard != "") | has_any(low, NORM_WORDS), "normative").when((vendor != "") | has_any(low, CATALOG_WORDS), "catalog").otherwise("technical")
    ext = extension(document)
    return F.struct(
        kind.alias("doc_type"), vendor.alias("vendor"), standard.alias("standard_id"), F.nullif(year, blank).cast("int").alias("year"),
        script_language(probe).alias("lang"), F.when(ext.isin(*KNOWN_EXTENSIONS), ext).otherwise("unknown").alias("source_type"),
    )


def minimal_record(text: Column, document: Column, page: Column, section: Column, chunk_index: Column) -> list[Column]:
    """The twelve fields of a retrieval record."""
    meta = infer_metadata(text, document, section)
    blank, zero = F.lit(""), F.lit(0)
    head = [F.coalesce(text, blank).alias("text"), F.coalesce(document, blank).alias("document"), F.coalesce(page, zero).alias("page"), F.coalesce(section, blank).alias("section"), F.coalesce(chunk_index, zero).alias("chunk_index"), count_tokens(text).alias("token_count")]
    return [*head, *(meta[k].alias(k) for k in ("doc_type", "vendor", "standard_id", "year", "lang", "source_type"))]


def source_type(filename: Column, media_type: Column, extractor: Column) -> Column:
    """By extension, else media type, else extractor."""
    pick = lambda table, key: reduce(lambda w, kv: w.when(key == kv[0], kv[1]), list(table.items())[1:], F.when(key == next(iter(table)), next(iter(table.values()))))
    media = F.lower(strip(F.element_at(F.split(F.coalesce(media_type, F.lit("")), ";"), 1)))
    named = F.lower(F.coalesce(extractor, F.lit("")))
    return F.coalesce(pick(SOURCE_BY_EXTENSION, extension(filename)), pick(SOURCE_BY_MEDIA_TYPE, media), F.when(named == "html-xml", "html").when(named != "", named), F.lit("unknown"))


def document_class(kinds: Column) -> Column:
    """Tabular if half of the blocks are tables, structured with any heading, list item or table, else text."""
    tables = _count(kinds, lambda k: k == "table")
    return F.when((tables > 0) & (2 * tables >= F.size(kinds)), "tabular").when(F.arrays_overlap(kinds, F.array(F.lit("heading"), F.lit("list_item"), F.lit("table"))), "structured").otherwise("text")


def _mostly_symbols(c: Column) -> Column:
    n = F.length(c).cast("double")
    letters, digits, symbols = count_chars(c, r"\p{L}"), count_chars(c, r"\p{Nd}"), count_chars(c, r"[^\p{L}\p{N}\p{Z}\p{Cc}]")
    return (letters < 0.45 * n) & ((symbols > 0.18 * n) | (digits > 0.40 * n))


def _pipe_lines(c: Column) -> Column:
    return _count(F.split(c, "\n"), lambda x: x.contains("|"))


def is_noisy_legacy(c: Column | str) -> Column:
    """B13, older form: short texts never; glyph codes always; tables never."""
    c = col(c)
    codes = F.regexp_count(c, F.lit(r"\(cid:"))
    return (F.length(c) >= 200) & ((codes > 5) | ((_pipe_lines(c) < 2) & _mostly_symbols(c)))


def is_noisy(c: Column | str) -> Column:
    """B13, newer form: glyph codes at any length, and replacement characters."""
    c = col(c)
    codes, broken = F.regexp_count(c, F.lit(r"\(cid:")), count_chars(c, "\ufffd")
    return (codes > 5) | ((F.length(c) >= 200) & ((broken > 0.02 * F.length(c)) | ((_pipe_lines(c) < 2) & _mostly_symbols(c))))


def is_metadata_row(c: Column | str) -> Column:
    """Administrative rows."""
    c = col(c)
    return has_any(F.lower(c), METADATA_WORDS) | any_of([c.rlike(p) for p in METADATA_PATTERNS])


def is_ocr_garbage(c: Column | str, least: float = 0.4) -> Column:
    """Too few letters and digits in 20 characters or more."""
    c = col(c)
    return (F.length(c) >= 20) & (count_chars(c, r"[\p{L}\p{N}]") < least * F.length(c))


def is_office_boilerplate(c: Column | str) -> Column:
    """Contact blocks."""
    return any_of([col(c).rlike(p) for p in OFFICE_PATTERNS])


def keep_chunk(text: Column, chunk_type: Column, min_length: int = 20, metadata: bool = True, ocr: bool = True, cid: bool = True, office: bool = True, include: str | None = None, exclude: str | None = None) -> Column:
    """The filter chain; headings always stay."""
    text = F.coalesce(text, F.lit(""))
    keep = F.length(strip(text)) >= min_length
    for on, test in ((metadata, is_metadata_row), (ocr, is_ocr_garbage), (cid, is_cid_garbage), (office, is_office_boilerplate)):
        if on:
            keep &= ~test(text)
    if include:
        keep &= text.rlike(include)
    if exclude:
        keep &= ~text.rlike(exclude)
    return F.coalesce(chunk_type == "heading", F.lit(False)) | keep


def classify_content(c: Column | str) -> Column:
    """struct(label, confidence, reason) from weighted rules."""
    c = col(c)
    hit = lambda rules: [(F.coalesce(c.rlike(p), F.lit(False)), name, w) for name, p, w in rules]
    noise, value = hit(NOISE_RULES), hit(VALUE_RULES)
    total = lambda hits: reduce(lambda a, b: a + b, [F.when(t, F.lit(w)).otherwise(0.0) for t, _, w in hits])
    reasons = lambda hits: F.concat_ws("+", *[F.when(t, F.lit(n)) for t, n, _ in hits])
    n, v = total(noise), total(value)
    verdict = lambda label, confidence, reason: F.struct(F.lit(label).alias("label"), confidence.alias("confidence"), reason.alias("reason"))
    return (
        F.when(v > n, verdict("valuable", F.least(F.lit(1.0), v / (v + n + 0.1)), reasons(value)))
        .when((n > 0) & (v == 0), verdict("noise", F.least(F.lit(1.0), n / (n + 1.0)), reasons(noise)))
        .otherwise(verdict("ambiguous", F.lit(0.5), F.when(n > 0, "mixed").otherwise("unknown")))
    )


def row_grade(attributes: Column) -> Column:
    """Mean score of the attributes that have a value, 0 to 1."""

    def score(entry: Column) -> Column:
        key, value = entry["key"], strip(entry["value"])
        by_key = F.when(F.lower(key).isin(*HIGH_VALUE_FIELDS), 0.5).when(key.startswith("col_") | (key == "line"), 0.1).otherwise(0.4)
        bonus = lambda test, w: F.when(test, w).otherwise(0.0)
        return by_key + 0.25 + bonus(value.rlike(r"\p{Nd}"), 0.05) + bonus(value.rlike(ROW_UNITS), 0.1) + bonus(any_of([value.rlike(p) for p in ROW_CODES]), 0.1) + bonus(F.length(value) > 5, 0.05)

    filled = F.filter(F.map_entries(attributes), lambda e: e["value"].isNotNull() & (strip(e["value"]) != ""))
    total = F.aggregate(filled, F.lit(0.0), lambda a, e: a + score(e))
    return F.least(F.lit(1.0), F.coalesce(F.try_divide(total, F.size(filled)), F.lit(0.0)))


def term_score(text: Column, terms, anti_terms=(), penalty: int = 2) -> Column:
    """Terms present, less ``penalty`` for each anti-term present."""
    low = F.lower(F.coalesce(text, F.lit("")))
    present = lambda words, w: [F.when(low.contains(t), w).otherwise(0) for t in words]
    return reduce(lambda a, b: a + b, [*present(terms, 1), *present(anti_terms, -penalty)], F.lit(0))


def density_score(text: Column, terms, anti_terms=(), path: Column | None = None) -> Column:
    """Term score by density, truncated, less 3 on editorial paths."""
    text = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    score = (term_score(text, terms, anti_terms) * 1000 / n * (F.least(n, F.lit(2000.0)) / 1000)).cast("int")
    if path is not None:
        score -= F.when(F.lower(path).rlike(r"/(article|story|press|blog|interview|obzor|analitika)/"), 3).otherwise(0)
    return score


def search_tokens(c: Column | str) -> Column:
    """Lower-cased words of three characters or more, without stop words."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit("[A-Za-zА-Яа-яЁё0-9]{3,}"), F.lit(0))
    return F.filter(F.transform(found, F.lower), lambda w: ~w.isin(*STOPWORDS))


def fold_text(c: Column | str) -> Column:
    """White space collapsed, stripped, lower-cased."""
    return F.lower(strip(F.regexp_replace(F.replace(F.coalesce(col(c), F.lit("")), F.lit("\r"), F.lit("")), r"(?U)\s+", " ")))


def with_breadcrumb(text: Column, section: Column, doc_title: Column | str = "", domain: Column | str = "", header: Column | str = "") -> Column:
    """B33: 'domain | title > section | header' and an empty line before the text."""
    part = lambda c: F.nullif(F.lit(c) if isinstance(c, str) else c, F.lit(""))
    crumb = F.concat_ws(" | ", part(domain), F.nullif(F.concat_ws(" > ", part(doc_title), part(section)), F.lit("")), part(header))
    return F.when(crumb != "", F.concat(crumb, F.lit("\n\n"), text)).otherwise(text)


def safe_text(c: Column, fallback: str, max_length: int) -> Column:
    """A short stripped text, or the fallback."""
    c = strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when((c != "") & (F.length(c) <= max_length), c).otherwise(fallback)


def render_markdown(text: Column, kind: Column) -> Column:
    """A block as Markdown."""
    text = strip(F.coalesce(text, F.lit("")))
    return F.when((kind == "heading") & (text != "") & ~text.startswith("#"), F.concat(F.lit("## "), text)).when((kind == "list_item") & (text != "") & ~text.rlike(r"^[-*+] "), F.concat(F.lit("- "), text)).otherwise(text)


def content_hash(c: Column) -> Column:
    """16 hex digits of the SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def heading_level(c: Column | str) -> Column:
    """1 for capitals of 8 characters or more, 2 for numbered, else 3."""
    c = col(c)
    return F.when(c.rlike(r"^[A-ZА-ЯЁ\s\d\-\.\,]{8,}$"), 1).when(c.rlike(r"^\d{1,3}[\.\)]\s+"), 2).otherwise(3)


def clean_parsed(c: Column | str) -> Column:
    """No invisible characters; mirrored Cyrillic is turned round."""
    c = F.regexp_replace(col(c), "[\ufeff\u200b\u200c\u200d\u2060]", "")
    s = strip(c)
    mirrored = (F.length(s) >= 5) & (count_chars(s, "[\u0400-\u04ff]") >= 0.5 * F.length(s)) & any_of([s.startswith(m) for m in REVERSED_STARTS]) & ~any_of([s.startswith(m) for m in NORMAL_STARTS])
    return F.when(mirrored, F.reverse(c)).otherwise(c)


def timeout_seconds(filename: Column, cells: Column, megabytes: Column) -> Column:
    """Q4: seconds that a file may take, 120 to 7200."""
    ext = F.lower(F.element_at(F.split(filename, r"\."), -1))
    base = F.when(ext.isin("xlsx", "xls", "csv"), 120 + F.floor(cells * 2 / 1000)).when(ext == "pdf", 300 + (megabytes * 10).cast("int")).otherwise(600)
    return F.greatest(F.lit(120), F.least(F.lit(7200), base)).cast("int")

"""HTML and XML to ordered blocks: a small tree from the standard library's parser, and extraction rules on it.

The tree closes nothing by itself: an unclosed paragraph holds what follows, and an end tag closes up to the nearest open
element of its name. Parsing runs row by row in the tasks; what comes after it (filters, first occurrences) is native.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweave.rows import each_row

#: Elements that never hold content, and elements whose text makes a block.
DROPPED = {"script", "style", "noscript", "svg", "meta", "link", "nav", "header", "footer", "aside"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NEUTRAL_BLOCKS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "table", "pre", "blockquote", "dl"}
WEB_BLOCKS = {"h1", "h2", "h3", "h4", "p", "li", "table", "dl", "pre"}
#: Class and id words of page furniture and shop parts.
FURNITURE = re.compile(r"(?i)cookie|breadcrumb|sidebar|menu|nav|banner|advert|social|share|popup|modal|overlay")
SHOP = re.compile(
    r"(?i)right.?column|sticky.?col|manager.?contact|subscribe.?form|cart|basket|order.?form|buy.?block|price.?block|delivery.?block|add.?to.?cart"
    r"|purchase|checkout|wishlist|compare.?block|callback|feedback.?form|links.?right|promo.?banner|action.?button|cta"
    r"|review|rating|stars|отзыв|рейтинг|recommend|similar.?product|recently.?viewed|also.?bought|related.?product|accessories"
)
#: Phrases of shop texts: orders, prices, delivery, contacts, reviews, notices.
SHOP_PHRASES = (
    r"(?iu)пришлите заявку|добавить в корзину|купить сейчас|в корзину|оформить заказ|рассчитать доставку|минимальная сумма заказа|самовывоз"
    r"|конкурентный счет|предложим лучшую цену|способ[ыь]? оплаты|гарантия\s*[-–—]\s*\d+|ответ в течение|подберите товар с менеджером"
    r"|отправить заявку|закажите звонок|заказать обратный звонок|от \d+ руб|от \d+ дн|add to cart|buy now|доставим в[:\s]"
    r"|транспортной компанией|курьером|огромный выбор|качество по госту|\d+ товар[ов]*$|^гарантия$|^цена\b|^цены на\b|^скидк|^акци[яи]$"
    r"|нужна помощь в выборе|помощь в выборе|наши менеджеры|свяжитесь с нами|задать вопрос менеджеру|помочь вам по телефону|обратный звонок"
    r"|написать менеджеру|связаться с менеджером|8[\s-]?800[\s-]?\d{3}[\s-]?\d{2}[\s-]?\d{2}"
    r"|\+7[\s-]?\(?\d{3}\)?[\s-]?\d{3}[\s-]?\d{2}[\s-]?\d{2}|электронной почте\s+\S+@\S+|\d[\d\s]+₽|рекомендованная розничная цена"
    r"|базовая цена\s*\d|купить данный товар .+ по цене|по цене \d+ руб|по привлекательной цене|\d[\d.]*\s+из\s+\d+\s+звезд"
    r"|^recent reviews$|^customer reviews$|отзыв[оы]|^нет в наличии$|^узнать наличие$|^узнать статус заказа$"
    r"|сроки готовности товара указаны в .+ корзине|^в упаковке:$|^доступно$|^упак\.$|^по убыванию$|^по возрастанию$|^сравнить$"
    r"|^избранное$|изображение является справочным|на главном складе|групповая упаковка \d+ шт|в ассортименте интернет-магазина"
    r"|оформить и оплатить заказ можно|условия продажи, доставки и цены|рекомендуем ознакомиться с описанием|мы используем cookie"
    r"|вы соглашаетесь .+ метрических программ|на нашем сайте используются|рекомендательные технологии|файлов cookie"
    r"|официальный дилер продукции|товар с гарантией производителя|^где забрать\?$|^как оплатить\?$|правила оплаты банковской картой"
    r"|^б/н расчет|^вы недавно смотрели$|^последние просмотренные|^аналоги и похожие товары$|^с этим товаром покупают$"
    r"|^вам могут понадобиться$|^рекомендуем вам$|^популярные товары в категории$|^справочник по гостам, снипам, остам"
    r"|скачать документ бесплатно|не нашли на портале нужный вам документ|разместите нашу кнопку на своем сайте|^html-код:$|gostinform\.ru"
)
REVIEW_DATE = r"(?iu)^(янв|февр|март|апр|май|июн|июл|авг|сент|окт|нояб|дек)\S*\s+\d{4}\s*г?\.\s*$"


def latin_part(pattern: str) -> str:
    """The alternatives of a pattern that can match a text without characters from U+0300 on: those that, without their classes,
    groups and optional characters, have no such character. Long lists of Cyrillic phrases come down to a few for Latin texts."""
    flags, rest = re.match(r"(\(\?\w+\))?(.*)", pattern, re.DOTALL).groups(default="")
    whole = re.fullmatch(r"\^\(([^()]*)\)\$", rest)
    cut, depth, at, inside = [], 0, 0, whole.group(1) if whole else rest
    for m in re.finditer(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|[()|]", inside, re.DOTALL):
        depth += (m.group() == "(") - (m.group() == ")")
        if m.group() == "|" and depth == 0:
            cut.append(inside[at : m.start()])
            at = m.end()
    cut.append(inside[at:])
    needed = lambda x: re.sub(r"\([^()]*\)|\[\^?\]?(?:\\.|[^\]\\])*\]|[^\\][?*{]", "", x)
    kept = "|".join(x for x in cut if "(" in needed(x) or all(c < "\u0300" for c in needed(x)))
    return flags + (f"^({kept})$" if whole else kept) if kept else "(?!)"


LATIN = r"^[\x00-\u02ff]*$"


class Node:
    __slots__ = ("name", "attrs", "kids")

    def __init__(self, name: str, attrs: dict[str, str] | None = None):
        self.name, self.attrs, self.kids = name, attrs or {}, []

    def walk(self):
        """Elements below this one, in order (no recursion: pages may nest deeply)."""
        stack = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [k for k in reversed(node.kids) if isinstance(k, Node)]

    def find(self, *names: str):
        return next((n for n in self.walk() if n.name in names), None)

    def text(self, mark: str) -> str:
        parts, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if node.strip():
                    parts.append(node.strip())
            else:
                stack += reversed(node.kids)
        return mark.join(parts)

    def prune(self, gone) -> None:
        stack = [self]
        while stack:
            node = stack.pop()
            node.kids = [k for k in node.kids if isinstance(k, str) or not gone(k)]
            stack += [k for k in node.kids if isinstance(k, Node)]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].kids.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def parse(markup: str) -> Node:
    builder = _Builder()
    builder.feed(markup)
    builder.close()
    return builder.root


def tidy(text: str) -> str:
    return re.sub(r"[ \t]+", " ", re.sub(r"\n{3,}", "\n\n", text.replace("\r", ""))).strip()


def _table(node: Node) -> str:
    rows = ([tidy(c.text(" ")) for c in row.walk() if c.name in ("th", "td")] for row in node.walk() if row.name == "tr")
    return "\n".join(" | ".join(filter(None, cells)) for cells in rows if any(cells))


def _blocks(content: Node, names: set[str], lists: bool) -> list[str]:
    out = []
    for node in content.walk():
        if node.name in names:
            if node.name == "table":
                out.append(_table(node))
            elif node.name == "dl" and lists:
                out.append("\n".join(filter(None, (tidy(k.text(" ")) for k in node.kids if isinstance(k, Node) and k.name in ("dt", "dd")))))
            else:
                out.append(tidy(node.text(" ")))
    out = [b for b in out if b]
    return out or [p.strip() for p in re.split(r"\n\s*\n", tidy(content.text("\n"))) if p.strip()]


def neutral_blocks(markup: str) -> list[str]:
    """Blocks of the main part, each once."""
    root = parse(markup)
    root.prune(lambda n: n.name in DROPPED)
    return list(dict.fromkeys(_blocks(root.find("main") or root.find("article") or root.find("body") or root, NEUTRAL_BLOCKS, False)))


def web_blocks(markup: str) -> list[str]:
    """Blocks without page furniture, shop parts and buttons; the main part only if it has three blocks or more."""
    root = parse(markup)
    marked = lambda n: any(p.search(n.attrs.get(a, "")) for a in ("class", "id") for p in (FURNITURE, SHOP) if n.attrs.get(a))
    root.prune(lambda n: n.name in DROPPED or n.name == "button" or marked(n))
    main = root.find("main") or root.find("article")
    if main is not None and len(found := _blocks(main, WEB_BLOCKS, True)) >= 3:
        return found
    return _blocks(root.find("body") or root, WEB_BLOCKS, True)


def html_blocks(pages: DataFrame, key: str, html: str, web: bool = False) -> DataFrame:
    """(key, pos, text) for each block of each page. A page that can't be parsed has no blocks."""
    read = web_blocks if web else neutral_blocks

    def extract(k, markup):
        try:
            found = read(markup or "")
        except (AssertionError, ValueError, RecursionError):
            found = []
        return ((k, i, b) for i, b in enumerate(found))

    kind = dict(pages.dtypes)[key]
    rows = each_row(pages.select(F.col(key).alias("k"), F.col(html).alias("h")), extract, f"k {kind}, pos int, text string").withColumnRenamed("k", key)
    return drop_shop_blocks(rows, key) if web else rows


def drop_shop_blocks(blocks: DataFrame, key: str) -> DataFrame:
    """No shop phrases, review dates and bare numbers; each text once for a key, the first one stays."""
    trimmed = F.trim("text")
    shop = F.when(F.col("text").rlike(LATIN), F.col("text").rlike(latin_part(SHOP_PHRASES))).otherwise(F.col("text").rlike(SHOP_PHRASES))
    kept = blocks.where(~shop & ~trimmed.rlike(REVIEW_DATE) & ~trimmed.rlike(r"^\d{4,}$"))
    return kept.withColumn("n", F.row_number().over(Window.partitionBy(key, F.lower(trimmed)).orderBy("pos"))).where("n = 1").drop("n")

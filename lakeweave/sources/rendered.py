"""Text that a browser rendered, as blocks: an ordered fold over one page's lines, in one Arrow pass.

Lines are judged one by one (native patterns would do), but whether a line counts depends on what came before:
a page's content has begun, a section of related products is open, a specification table is running.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.rows import each_row
from lakeweave.sources.markup import LATIN, SHOP_PHRASES, drop_shop_blocks, latin_part

#: Single lines of navigation, prices and delivery, footers, related products and shop filler.
NAVIGATION = re.compile(
    r"(?i)^(каталог|корзина|избранное|войти|меню|заказы|сравнить|поделиться|ещё|назад|магазины|распродажа|акции|новинки|показать ещё"
    r"|загрузить ещё|читать далее|нашли дешевле|в корзину|в избранное|в смету|сравнить|©|политика|cookie|подписаться|рассылк|наверх"
    r"|скачать приложение|закрыть|стройматериалы|инструмент|финишная отделка|товары для дома|сантехника|крепеж|сад и досуг"
    r"|инженерные системы|найти|сервисы|сметы|вакансии|о нас|о компании|новости|история компании|пресс-служба|служба поддержки"
    r"|подарочные|клуб друзей|мы принимаем к оплате|мобильные приложения|отсканируйте|биржа профессионалов|петрович b2b|возврат товара"
    r"|для юридических лиц|распил|колеровка|аренда инструмента|переборка|расчет материалов|установка дверей|укладка|замер"
    r"|приемка квартир|помощник по дизайну|программы лояльности|b2b|зарегистрировать карту|каталог призов|аналоги|популярно в категории"
    r"|вам могут понадобиться|сопутствующие предложения|доставка и подъем|описание|детали|характеристики|отзывы|вопросы|сертификаты"
    r"|штуку|штука|цена за|код:|похожие|на нашем сайте используются|рекомендательные технологии|соглашаетесь на использование|файлов cookie)$"
)
PRICES = re.compile(
    r"(?i)^\d[\d\s]*₽$|^от\s+\d|^\d+\s*(шт|руб|р\.|₽)|^доставк|^самовывоз|^привезем|^наличие|^в наличии|^нет в наличии|^под заказ|^долями"
    r"|^плати частями|^рассрочк|^доставим|^если мы опоздали|^при заказе|^круглосуточно|^товар на складе|^\d+\s*шт$|^делите стоимость"
    r"|^сейчас\s+\d|^\d+/\d+\s+в\s+\d|оставаясь на сайте"
)
FOOTER = re.compile(r"(?i)^(о компании|покупателям|контакты|© \d{4}|при полном или частичном)$")
RELATED = re.compile(r"(?i)вам могут понадобиться|сопутствующие|похожие товары|с этим товаром|рекомендуем также|популярно в категории|аналоги|покупают вместе|вы смотрели|недавно просмотренные|вас может заинтересовать")
FILLER = re.compile(r"(?i)в ассортименте (интернет-)?магазина|оформить и оплатить заказ|условия продажи|можно купить с доставкой|рекомендуем ознакомиться с описанием|доступны по привлекательной цене")
SPEC = re.compile(r"^[А-Яа-яA-Za-z\s,/()]{3,50}\s*[:|]\s*.+")
SHOP = re.compile(SHOP_PHRASES.replace("(?iu)", "(?i)"))
#: The patterns above for lines of any text, and what of them can match a line of Latin text.
ANY = (FOOTER, RELATED, FILLER, NAVIGATION, PRICES, SHOP)
ONLY_LATIN = tuple(re.compile(latin_part(p.pattern)) for p in ANY)
IS_LATIN = re.compile(LATIN)


def rendered_blocks(text: str) -> list[str]:
    out: list[str] = []
    prose: list[str] = []
    table: list[str] = []
    begun = related = False

    def close(prose_too: bool = True) -> None:
        if table:
            out.append("\n".join(table))
            table.clear()
        if prose_too:
            if len("\n".join(prose)) > 20:
                out.append("\n".join(prose))
            prose.clear()

    for line in map(str.strip, text.split("\n")):
        if len(line) < 3:
            close()
            continue
        footer, others, filler, navigation, prices, shop = ONLY_LATIN if IS_LATIN.match(line) else ANY
        if begun and footer.match(line):
            break
        elif others.search(line):
            close()
            related = True
        elif filler.search(line) or navigation.match(line) or prices.search(line) or shop.search(line) or (len(line) < 30 and line.startswith("—")):
            continue
        else:
            begun = begun or len(line) > 40
            spec = len(line) < 200 and bool(SPEC.match(line))
            related = related and not spec and len(line) <= 100
            if related:
                continue
            if spec:
                if prose:  # a table ends the prose before it
                    out += ["\n".join(prose)] if len("\n".join(prose)) > 20 else []
                    prose.clear()
                table.append(re.sub(r"\s*:\s*", " | ", line, count=1) if ":" in line else line)
            else:
                close(prose_too=False)
                prose.append(line)
    close()
    return out


def rendered_pages(pages: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, text) of rendered pages, less shop blocks and repeats."""

    kind = dict(pages.dtypes)[key]
    blocks = each_row(pages.select(F.col(key).alias("k"), F.col(text).alias("t")), lambda k, t: ((k, i, b) for i, b in enumerate(rendered_blocks(t or ""))), f"k {kind}, pos int, text string")
    return drop_shop_blocks(blocks.withColumnRenamed("k", key), key)

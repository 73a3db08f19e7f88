"""Patterns cut down for Latin texts find the same there."""

import random
import re

from lakeweave.sources import rendered
from lakeweave.sources.markup import SHOP_PHRASES, latin_part

SAID = ("add to cart", "BUY NOW", "8 800 123 45 67", "+7 (999) 123-45-67", "gostinform.ru", "recent reviews", "customer reviews", "© 2020", "©", "cookie", "b2b", "3/4 x", "12", "words", "ähnlich", "£", "— ", " ", "5 ", "html", "code:")


def test_latin_parts_agree():
    rng = random.Random(1)
    lines = [*SAID, *("".join(rng.choices(SAID, k=rng.randint(1, 4))) for _ in range(5000)), *("".join(map(chr, rng.choices(range(0x20, 0x300), k=12))) for _ in range(3000))]
    lines = [x for x in lines if rendered.IS_LATIN.match(x) and "\n" not in x]
    for whole, part in zip(rendered.ANY, rendered.ONLY_LATIN, strict=True):
        assert [bool(whole.search(x)) for x in lines] == [bool(part.search(x)) for x in lines]
    assert any(map(rendered.SHOP.search, lines)) and any(map(rendered.NAVIGATION.search, lines))
    assert len(latin_part(SHOP_PHRASES)) < len(SHOP_PHRASES) / 4
    assert latin_part("(?i)^цена|тов(ар|x)|a(b|я)|[я]c|d\\||ж?e") == "(?i)a(b|я)|[я]c|d\\||ж?e"
    assert re.match(rendered.IS_LATIN, "é") and not re.match(rendered.IS_LATIN, "ж")

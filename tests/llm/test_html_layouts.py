"""Main texts of generated layouts whose article is known: hosts with menus, sidebars, comments
and notices of many names, articles in parts, and parts whose class names sound like noise."""

from __future__ import annotations

import random

import pytest

from slotwise.llm import html_text
from slotwise.llm.common import prepare


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8))) for _ in range(n)).capitalize() + "."


def links(rng: random.Random, n: int) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{prose(rng, 3)}</a></li>' for i in range(n)) + "</ul>"


def main_texts(spark, pages: list[tuple[str, str]]) -> list[str]:
    prepare(spark)
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in sorted(html_text.main_text(df).collect(), key=lambda r: r.page_id)]


#: (class of the noise, unique text on each page)
NOISES = [("site-header", False), ("main-nav", None), ("comment-list", True), ("cookie-notice", False), ("related-posts", None), ("ad-banner", "short"),
          ("newsletter-signup", False), ("page-footer", False), ("social-share", None), ("sidebar", True), ("footer", True), ("comments", True)]


def noise(rng: random.Random, fixed: random.Random, name: str, unique) -> str:
    inner = links(rng, 8) if unique is None else f"<p>{prose(rng, 6)}</p>" if unique == "short" else \
        "".join(f"<p>{prose(rng if unique else fixed, 25)}</p>" for _ in range(3))
    return f'<div class="{name}">{inner}</div>'


@pytest.mark.parametrize("shape", ["article", "content", "two parts", "deep"])
def test_generated_hosts(spark, shape):
    pages, wanted = [], []
    for host in range(4):
        rng = random.Random(f"{shape}{host}")
        names = rng.sample(NOISES, 6)
        for page in range(12):
            paragraphs = [prose(rng, rng.randint(15, 60)) for _ in range(rng.randint(5, 9))]
            title = prose(rng, 6)
            body = "".join(f"<p>{p}</p>" for p in paragraphs)
            split = max(1, round(len(paragraphs) * 0.8))
            main = {"article": f"<article><header><h1>{title}</h1></header>{body}</article>",
                    "content": f'<div class="content"><h1>{title}</h1>{body}</div>',
                    "two parts": f'<div class="content"><h1>{title}</h1>' + "".join(f"<p>{p}</p>" for p in paragraphs[:split]) + '</div><div class="more">'
                                 + "".join(f"<p>{p}</p>" for p in paragraphs[split:]) + "</div>",
                    "deep": f'<div class="wrap"><main><section class="s{page}"><h1>{title}</h1>{body}</section></main></div>'}[shape]
            around = [noise(rng, random.Random(f"{host}{n}"), n, u) for n, u in names]
            pages.append((f"https://h{host}.example/{page}", f"<html><head><title>x</title></head><body><nav>{links(rng, 5)}</nav>"
                          f"{''.join(around[:3])}{main}{''.join(around[3:])}<footer>{prose(rng, 8)}</footer></body></html>"))
            wanted.append(" ".join([title, *paragraphs]))
    got = main_texts(spark, pages)
    wrong = [i for i, (g, w) in enumerate(zip(got, wanted)) if g != w]
    assert not wrong, (len(wrong), got[wrong[0]][:200], wanted[wrong[0]][:200], pages[wrong[0]][1][:800])


@pytest.mark.parametrize("pages_of_host", [1, 20])
def test_names_that_sound_like_noise(spark, pages_of_host):
    rng = random.Random(5)
    pages, wanted = [], []
    for k, name in enumerate(["ad-free-article", "share-price", "alert-rules", "widget-guide", "search-engine-history", "page-header"]):
        for p in range(pages_of_host):
            parts = [prose(rng, 50) for _ in range(4)]
            pages.append((f"https://n{k}.example/{p}", f'<body><nav>{links(rng, 6)}</nav><article><p>{parts[0]}</p><div class="{name}"><p>{parts[1]}</p>'
                          f'<p>{parts[2]}</p></div><p>{parts[3]}</p></article><div class="site-footer">{prose(random.Random(k), 12)}</div></body>'))
            wanted.append(" ".join(parts))
    assert main_texts(spark, pages) == wanted


def test_a_second_part_that_never_wins(spark):
    rng = random.Random(6)
    pages, wanted = [], []
    for p in range(20):
        a, b, meta = prose(rng, 170), prose(rng, 30), prose(rng, 3)
        pages.append((f"https://two.example/{p}", f'<body><div class="content"><p>{a}</p></div><div class="more"><p>{b}</p></div>'
                      f'<div class="box">{links(rng, 6)}</div><div class="legal">The same words on every page of this host.</div></body>'))
        wanted.append(f"{a} {b}")
    assert main_texts(spark, pages) == wanted

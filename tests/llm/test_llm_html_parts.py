import pytest

from catalign.llm.extract_html import main_text

PARA = "Some words, with commas, that make a paragraph of fair length for scoring, indeed."


@pytest.mark.parametrize("opened, closed", [
    ('<article class="post category-social">', "</article>"), ('<main class="main has-sidebar">', "</main>"),
    ('<div class="content-sidebar-wrap">', "</div>"), ('<div class="page with-header">', "</div>"), ('<section id="legal-history">', "</section>"),
    ('<div class="sidebar"><article>', "</article></div>"), ('<article class="related">', "</article>"), ("<form action=/><div>", "</div></form>")])
def test_article_and_wrappers_stay(opened, closed):
    page = f"<html><body><nav>menu</nav>{opened}<p>{PARA}</p><p>{PARA}</p>{closed}<div class='comments'><article><p>Nice.</p></article></div></body></html>"
    assert main_text(page) == f"{PARA} {PARA}"


def test_siblings_and_text_of_the_parent_stay():
    short = "Three hundred, characters, or so, of text. " * 7
    page = (f"<body><div>{('<p>' + PARA * 4 + '</p>') * 10}</div><div><p>{short}</p></div><h3>Head</h3>loose <a href=x>linked</a> text"
            "<ul><li>one</ul><p>end</p><div><a href=y>more</a> <a href=z>links</a></div></body>")
    assert main_text(page).endswith(f"{short.strip()} Head loose linked text one end")

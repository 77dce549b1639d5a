from newsloom.operators import markup


def outline(html):
    nodes, last = markup.scan(html)
    return [(n[2] if n[2] != markup.TEXT else n[4], n[0], last[i]) for i, n in enumerate(nodes)]


def test_open_paragraph_ends_at_the_next_one_with_its_inline_elements():
    assert outline("<p><b>xxx<br><p>yyy") == [
        ("p", -1, 3), ("b", 0, 3), ("xxx", 1, 2), ("br", 1, 3), ("p", -1, 5), ("yyy", 4, 5),
    ]


def test_block_ends_paragraph_but_sections_do_not():
    assert [n[1] for n in outline("<p>a<div>b</div>")] == [-1, 0, -1, 2]
    assert [n[1] for n in outline("<p>a<aside><p>b</p></aside>c")] == [-1, 0, 0, 2, 3, 0]


def test_list_items_and_cells():
    assert [n[1] for n in outline("<ul><li>a<li><p>b<li>c</ul>")] == [-1, 0, 1, 0, 3, 4, 0, 6]
    assert [n[1] for n in outline("<table><tr><td>a<td>b<tr><td>c</table>d")] == [
        -1, 0, 1, 2, 1, 4, 0, 6, 7, -1,
    ]


def test_misplaced_end_tags():
    assert outline("a</b>c") == [("ac", -1, 0)]
    # An inline end tag does not reach beyond an open block of higher rank.
    assert [n[1] for n in outline("<span><div>a</span>b")] == [-1, 0, 1]
    assert [n[1] for n in outline("<div><span>a</div>b")] == [-1, 0, 1, -1]


def test_entities_comments_and_stray_signs():
    assert [n[0] for n in outline("a < b &amp; c&amp<!-- x -->d &copy;<!unclosed>e")] == [
        "a < b & c&", "d ©", "e",
    ]
    assert [n[0] for n in outline("x<!-- never closed <p>y")] == ["x"]


def test_attributes():
    nodes, _ = markup.scan("<A HREF=foo/ title=it's x='a>b' y Y=2 u=\"?a=1&copy=2&amp;b\n\">t</A>")
    assert nodes[0][3] == {
        "href": "foo/", "title": "it's", "x": "a>b", "y": "", "u": "?a=1&copy=2&b\n",
    }


def test_tags_that_are_never_closed():
    assert outline('<a href="x" <b>t</b></a <i>u</i>') == [
        ("a", -1, 0), ("b", -1, 2), ("t", 1, 2), ("i", -1, 4), ("u", 3, 4),
    ]
    assert outline("x<p class=y") == [("x", -1, 0), ("p", -1, 1)]


def test_raw_text():
    nodes, _ = markup.scan("<script type=x>var t='</p>&amp;';</SCRIPT >a<style>b")
    assert [(n[2], n[4]) for n in nodes] == [
        ("script", None), (markup.TEXT, "var t='</p>&amp;';"), (markup.TEXT, "a"),
        ("style", None), (markup.TEXT, "b"),
    ]
    assert nodes[1][1] == markup.IN_HIDDEN and nodes[2][1] == 0


def test_enclosing_marks_are_inherited():
    html = (
        '<body class="x"><article><div class="RichTextComponentWrapper"><div data-component="text-block">'
        "<p>a</p></div></div></article><main><a><p>b</p></a></main>"
        '<div class="Sharing"></div><div class="my-PROMO"><p>c</p></div><nav><p>d</p></nav>'
    )
    nodes, _ = markup.scan(html)
    marks = [n[1] for n in nodes if n[2] == "p"]
    assert marks == [
        markup.IN_ARTICLE | markup.IN_RICH_TEXT | markup.IN_TEXT_BLOCK,
        markup.IN_MAIN | markup.IN_LINK,
        markup.IN_FURNITURE,
        markup.IN_FURNITURE,
    ]


def test_hostile_input_takes_linear_time():
    n = 20000
    for unit in ("<a", "</a", "<!", "</a b", "<a b='\"", '<a b="', "<a ", "<a x='", "<!--", "<p><b>", "</p>", "&", "<<", "<a b=", "</", "<div>", "<li>"):
        markup.scan(unit * n)
    markup.scan("<b>" * n + "<p></p>" * n)
    markup.scan("<b>" * n + "</i>" * n)

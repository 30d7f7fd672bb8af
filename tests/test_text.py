import html

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions import text as X

STEPS = [
    (X.html_to_text, "H<sub>2</sub>O", "H 2 O"),
    (X.html_to_text, "<i>X</i>, y", "X , y"),
    (X.html_to_text, "a<br/>b<!-- no > --> c", "a b c"),
    (X.html_to_text, "<p title=\"a>b\">x</p><script>var t='</p>';</script>y", "x y"),
    (X.html_to_text, "a <b>x</b> <script>var x=1", "a x"),
    (X.html_to_text, "a  <b> x</b>\n<style>p{}\n", "a x"),
    (X.html_to_text, "x<5 and y>3", "x<5 and y>3"),
    (X.strip_tags, "a<>b < c > d < e", "a<>b  d < e"),
    (X.html_to_text, "only < here &amp;", "only < here &amp;"),
    (X.html_to_text, "<b>a &lt;b&gt;</b>", "a <b>"),
    (X.html_to_text, "<b>two\n words</b>", "two\n words"),
    (X.strip_tags, "A<b>B</b>", "AB"),
    (X.decode_entities, "&lt;b&gt;", "<b>"),
    (X.decode_entities, "&amp;lt; &lt;", "&lt; <"),
    (X.unescape_quotes, 'say \\"hi\\"', 'say "hi"'),
    (X.unescape_quotes, "it\\\\'s", "it's"),
    (X.drop_media_markers, "Video: audio SEEN HERE videos", ":   videos"),
    (X.drop_media_markers, "éaudio audioé", "éaudio audioé"),
    (X.drop_wager_markers, "Daily Double dd add", "  add"),
    (X.mark_blanks, "a ____ b_c", "a [BLANK] b[BLANK]c"),
    (X.mark_links, "see http://a.b/c?x=[1];#frag ok", "see [LINK]#frag ok"),
    (X.drop_bracketed, "HISTORY (1900s) [x]", "HISTORY  "),
    (X.drop_bracketed, "a (b\nc) d", "a (b\nc) d"),
    (X.straighten_apostrophes, "caf’s ‘q‘", "caf's 'q'"),
    (X.straighten_dashes, "a – b — c", "a - b - c"),
    (X.straighten_quotes, "“q”", '"q"'),
    (X.collapse_punctuation, "Wait... what?!", "Wait. what!"),
    (X.drop_references, "a &lt; &#12; & b;", "a   & b;"),
    (X.squeeze_space, "  a \t\x1cb\n", "a b"),
    (X.strip, "  a b ", "a b"),
    (X.nonblank, "  \t", None),
]


@pytest.mark.parametrize("i", range(len(STEPS)))
def test_steps(apply, i):
    fn, given_text, expected = STEPS[i]
    assert apply(fn, [given_text]) == [expected]


CLEANED = [
    ("question", "http://a.b/c_d?x=1#frag ok", "[LINK]#frag ok"),
    ("question", None, ""),
    ("question", "“q”", "“q”"),
    ("question", "&amp;lt;", ""),
    ("question", "Audio clue: <i>seen here</i> it is ___.", "clue: it is [BLANK]."),
    ("answer", "audio ___ http://x.y z", "audio ___ [LINK] z"),
    ("category", "History (1900s) [x] <b>ß</b>", "HISTORY SS"),
    ("general", "A<b>B</b> &amp; C", "AB & C"),
    ("general", "it’s – fine…!?", "it's - fine…?"),
]


@pytest.mark.parametrize("i", range(len(CLEANED)))
def test_clean_text(apply, i):
    kind, given_text, expected = CLEANED[i]
    assert apply(lambda c: X.clean_text(c, kind), [given_text]) == [expected]


def test_fix_quotes_option(apply):
    assert apply(lambda c: X.clean_text(c, "answer", fix_quotes=True), ["“q”"]) == ['"q"']


def test_unknown_field_type_is_refused():
    with pytest.raises(ValueError):
        X.clean_text(F.lit("x"), "title")


def test_references_match_the_standard_decoder(apply):
    texts = ["", "&", "&&", "&amp", "&ampersand;", "&notit; &notin;", "&#0; &#13; &#128; &#x80; &#x9f &#129;"]
    texts += ["&#xD800; &#x110000; &#99999999999999999999; &#x1F600; &#xFFFF; &#11; &#xFDD0;", "&nosuch; &a b;&lt;;"]
    texts += ["&#; &#x; &#xg;", "&CounterClockwiseContourIntegral; &acE; &#000065; &#x000041"]
    texts += [f"&{n}x" for n in X._OPEN_NAMES]
    assert apply(X.decode_entities, texts) == [html.unescape(t) for t in texts]


pieces = st.sampled_from(["&", "amp", "lt", ";", "#", "x", "38", "41", "<", " ", "é", "😀", "not", "in", "&copy;", "&#233;"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(pieces, max_size=12).map("".join), min_size=1, max_size=60))
def test_references_property(apply, texts):
    assert apply(X.decode_entities, texts) == [html.unescape(t) for t in texts]


words = st.sampled_from(["<b>", "</b>", "&nbsp;", "&amp;", "  ", " ", "a", "B.", "!?", "“", "’", "__", "http://a", "dd", "\n", "(", ")"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(words, max_size=10).map("".join), min_size=1, max_size=60), st.sampled_from(X.FIELD_TYPES))
def test_cleaned_text_is_squeezed(apply, texts, kind):
    for out in apply(lambda c: X.clean_text(c, kind), texts):
        assert out == " ".join(out.split())


STEPS_ALONE = [X.strip, X.nonblank, X.html_to_text, X.strip_tags, X.decode_entities, X.squeeze_space, X.drop_markers, X.collapse_punctuation]


@pytest.mark.parametrize("run", [" ", "<", "<b", "&", "_", ".", "\n", "</script"])
def test_long_runs_take_linear_time(apply, run):
    import time

    text = "a <b>" + run * 100_000 + "b"
    for fn in [*STEPS_ALONE, *(lambda c, f=f: X.clean_text(c, f) for f in ("question", "answer", "general"))]:
        started = time.time()
        assert len(apply(fn, [text])[0]) <= len(text)
        assert time.time() - started < 10, fn

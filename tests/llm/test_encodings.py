"""Wrong encodings: clean texts of seven languages stay, every pair is undone, losses are states of the model."""

import pytest

from cordal.llm.mojibake import LOSS, PAIRS, label, restore

CLEAN = [
    "Die Straße ist für ältere Äpfel und Öl gesperrt.", "straße für äpfel", "Grüße aus München, Weißbier und Übermut.", "Größe",
    "Das Maß", "Fußball macht Spaß", "weiß nicht, heiß", "Müller, Schäfer, Jürgen",
    "Le cœur est à gauche; l'œdème régresse déjà, où ça ? Forêt, naïve, Noël, garçon.", "Élégant, Ça va très bien", "naïve façade", "Zoë",
    "È così che la città è più bella, perché no?", "A função ventricular não está alterada; há coração, pães, à direita.",
    "São Paulo, ação, êxito, avó", "Smørrebrød på Åland", "¿Cómo está? Ñandú – 37 °C, ≥ 3 µg", "Emoji 😀 limpio y útil",
    "http://x.org/a?b=1", "ver www.sitio.com/buscar?q=eco y listo",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_stays(text):
    assert restore(text) is None


@pytest.mark.parametrize("text", ["N? 123 de protocolo", "?Como esta hoy", "presi?n normal", "est� bien"])
def test_losses_come_from_the_model(text):
    assert restore(text) == ("", True, None)
    assert [u[2:] for u in label(text)] == [(LOSS, None)]


def read_wrongly(text, true, wrong, times):
    for _ in range(times):
        out = []
        for b in text.encode(true):
            try:
                out.append(bytes([b]).decode(wrong))
            except UnicodeDecodeError:
                out.append(chr(b))
        text = "".join(out)
    return text


@pytest.mark.parametrize("pair", PAIRS, ids=lambda p: "{}-{}-{}".format(*p))
@pytest.mark.parametrize("text", ["Emoji 😀 está allí", "El diámetro está aumentado en la región", "¿Qué presión? “normal” – 3 € ✓"])
def test_every_pair_is_undone(pair, text):
    try:
        bad = read_wrongly(text, *pair)
    except UnicodeEncodeError:
        pytest.skip("the text has characters beyond this encoding")
    if bad != text:
        assert restore(bad)[2] == text

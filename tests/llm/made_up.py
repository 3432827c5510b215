"""Made-up words for the tests."""

WORDS = [a + b for a in ("ba", "do", "ki", "lu", "mer", "nos", "pra", "ten", "vi", "zu") for b in ("lan", "mo", "rik", "sa", "tel", "un", "wes", "xo", "yar", "id")]

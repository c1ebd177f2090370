"""Column -> Column building blocks.

jsonx     Python ``json`` semantics from native expressions (J1, J2, J9, strict validity)
text      Python string semantics (strip/split), ``let`` and ``keep_where`` plan helpers
segments  chat-text segments, code fences, chat-response unpacking (J3, J6, J7, J8)
"""

"""Small texts of our own for the tests."""


def _conllu(number, text, rows):
    lines = [f"# sent_id = {number}", f"# text = {text}"]
    for i, (form, upos, head, deprel, *misc) in enumerate(rows, 1):
        lines.append("\t".join([str(i), form, form.lower(), upos, "_", "_", str(head), deprel, "_", *(misc or ["_"])]))
    return "\n".join(lines) + "\n\n"


# A root with many dependants, two verbs, and SpaceAfter marks; two sentences.
CONLLU_2 = _conllu(1, "Повар с другом принёс суп в зал и отнёс хлеб к окну.", [
    ("Повар", "NOUN", 4, "nsubj"), ("с", "ADP", 3, "case"), ("другом", "NOUN", 4, "obl"), ("принёс", "VERB", 0, "root"),
    ("суп", "NOUN", 4, "obj"), ("в", "ADP", 7, "case"), ("зал", "NOUN", 4, "obl"), ("и", "CCONJ", 9, "cc"),
    ("отнёс", "VERB", 4, "conj"), ("хлеб", "NOUN", 9, "obj"), ("к", "ADP", 12, "case"),
    ("окну", "NOUN", 9, "obl", "SpaceAfter=No"), (".", "PUNCT", 4, "punct")]) + _conllu(2, "Гости пили чай из кружек.", [
        ("Гости", "NOUN", 2, "nsubj"), ("пили", "VERB", 0, "root"), ("чай", "NOUN", 2, "obj"), ("из", "ADP", 5, "case"),
        ("кружек", "NOUN", 2, "obl", "SpaceAfter=No"), (".", "PUNCT", 2, "punct")])

POS_2 = {"NOUN": 9, "ADP": 4, "VERB": 3, "CCONJ": 1, "PUNCT": 2}

# Paths VERB -> NOUN -> ADP, by 0-based sentence.
PATTERN_2 = {0: [("принёс", "другом", "с"), ("принёс", "зал", "в"), ("отнёс", "окну", "к")], 1: [("пили", "кружек", "из")]}

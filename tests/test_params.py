from moodlake.functions import params as P


def test_every_genre_maps_to_a_defined_family():
    pairs = P.genre_family_pairs()
    assert len(pairs) == 114
    assert len({g for g, _ in pairs}) == 114
    for _, fam in pairs:
        assert fam in P.SUB_LABELS


def test_each_family_has_five_sub_labels():
    assert len(P.SUB_LABELS) == 10
    for fam, labels in P.SUB_LABELS.items():
        assert len(labels) == 5, fam
    names = [n for _, _, n, _ in P.sub_label_rows()]
    assert len(names) == 50 and len(set(names)) == 50


def test_ten_universal_moods_with_rules():
    assert len(P.UNIVERSAL_MOODS) == 10
    assert set(P.MOOD_RULES) == set(P.MOOD_NAMES)
    for fam, bias in P.GENRE_BIAS.items():
        assert fam in P.SUB_LABELS
        assert set(bias) <= set(P.MOOD_NAMES)


def test_weights_count():
    assert sum(len(w) for labels in P.SUB_LABELS.values() for _, _, w in labels) == 203

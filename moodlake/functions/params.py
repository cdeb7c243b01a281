"""Classification parameters as plain data.

Everything in this module is a FIXED VALUE that must equal the behaviour being
re-implemented for labels to come out right: mood names and their order, the
score rules, genre bias, the genre -> family map, and the sub-label weights in
their listed order (order decides first-wins ties and float summation order).
Operators turn these tables into Spark column expressions at plan-build time.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: universal moods, in tie-break order, with descriptions.
# ---------------------------------------------------------------------------
UNIVERSAL_MOODS: list[tuple[str, str]] = [
    ("Aggressive", "Intense, angry, and raw"),
    ("Euphoric", "Joyful, uplifting, peak happiness"),
    ("Energetic", "High-energy, pumped, and powerful"),
    ("Groovy", "Rhythmic, funky, and head-nodding"),
    ("Uplifting", "Hopeful, inspiring, and triumphant"),
    ("Relaxed", "Calm, feel-good, and easy-going"),
    ("Romantic", "Warm, intimate, and tender"),
    ("Melancholic", "Sad, reflective, and bittersweet"),
    ("Dark", "Brooding, moody, and ominous"),
    ("Dreamy", "Atmospheric, floating, and ethereal"),
]
MOOD_NAMES: list[str] = [m for m, _ in UNIVERSAL_MOODS]

# ---------------------------------------------------------------------------
# FIXED VALUES: universal mood rules.  Each mood has a first branch and an
# else-if branch; each branch is (points, [conditions]).  A condition is
# (feature, op, threshold); ("any", [...]) means an OR of conditions.
# e=energy v=valence d=danceability ac=acousticness in=instrumentalness m=mode
# ---------------------------------------------------------------------------
MOOD_RULES: dict[str, list[tuple[int, list]]] = {
    "Aggressive": [(10, [("energy", ">", 0.75), ("valence", "<", 0.35)]),
                   (6, [("energy", ">", 0.6), ("valence", "<", 0.3)])],
    "Euphoric": [(10, [("energy", ">", 0.7), ("valence", ">", 0.65), ("danceability", ">", 0.6)]),
                 (5, [("energy", ">", 0.6), ("valence", ">", 0.6)])],
    "Energetic": [(8, [("energy", ">", 0.7)]),
                  (4, [("energy", ">", 0.55)])],
    "Groovy": [(10, [("danceability", ">", 0.7), ("valence", ">", 0.45)]),
               (5, [("danceability", ">", 0.65), ("valence", ">", 0.4)])],
    "Uplifting": [(8, [("valence", ">", 0.6), ("mode", "=", 1)]),
                  (4, [("valence", ">", 0.55), ("mode", "=", 1)])],
    "Relaxed": [(10, [("energy", "<", 0.5), ("valence", ">", 0.4)]),
                (5, [("energy", "<", 0.55), ("valence", ">", 0.35)])],
    "Romantic": [(10, [("energy", "<", 0.5), ("acousticness", ">", 0.3), ("valence", ">", 0.2)]),
                 (4, [("energy", "<", 0.55), ("acousticness", ">", 0.15)])],
    "Melancholic": [(10, [("valence", "<", 0.35), ("energy", "<", 0.5)]),
                    (5, [("valence", "<", 0.4), ("energy", "<", 0.55)])],
    "Dark": [(10, [("valence", "<", 0.3), ("energy", ">", 0.4), ("mode", "=", 0)]),
             (5, [("valence", "<", 0.35), ("mode", "=", 0)])],
    "Dreamy": [(10, [("any", [("instrumentalness", ">", 0.3), ("acousticness", ">", 0.5)]), ("energy", "<", 0.6)]),
               (4, [("acousticness", ">", 0.3), ("energy", "<", 0.5)])],
}

# FIXED VALUES: bonus points per genre family (Pop has none).
GENRE_BIAS: dict[str, dict[str, int]] = {
    "Metal/Hardcore": {"Aggressive": 4, "Dark": 3},
    "Electronic/EDM": {"Energetic": 3, "Euphoric": 2},
    "Jazz/Soul": {"Groovy": 4, "Romantic": 3},
    "Classical/Ambient": {"Dreamy": 4, "Melancholic": 3},
    "Folk/Country": {"Relaxed": 3, "Romantic": 3},
    "Latin/World": {"Groovy": 3, "Euphoric": 3},
    "R&B/Funk": {"Groovy": 4, "Romantic": 3},
    "Hip-Hop/Rap": {"Dark": 3, "Aggressive": 2},
    "Rock/Alternative": {"Energetic": 2, "Dark": 2},
    "Pop": {},
}

DEFAULT_FAMILY = "Pop"

# ---------------------------------------------------------------------------
# FIXED VALUES: genre (lower-case) -> family.  114 genres, 10 families.
# ---------------------------------------------------------------------------
GENRE_FAMILIES: dict[str, list[str]] = {
    "Pop": ["acoustic", "anime", "cantopop", "children", "comedy", "dance", "disney", "happy",
            "indie-pop", "j-idol", "j-pop", "k-pop", "kids", "mandopop", "party", "pop", "pop-film",
            "power-pop", "sad", "show-tunes", "synth-pop"],
    "Hip-Hop/Rap": ["dancehall", "hip-hop", "reggaeton"],
    "Electronic/EDM": ["breakbeat", "chicago-house", "club", "deep-house", "detroit-techno", "disco",
                       "drum-and-bass", "dub", "dubstep", "edm", "electro", "electronic", "garage",
                       "hardstyle", "house", "idm", "minimal-techno", "progressive-house", "techno",
                       "trance", "trip-hop"],
    "Rock/Alternative": ["alt-rock", "alternative", "british", "emo", "goth", "grunge", "guitar",
                         "indie", "psych-rock", "punk", "punk-rock", "rock", "rock-n-roll",
                         "rockabilly", "ska"],
    "Jazz/Soul": ["groove", "jazz", "soul"],
    "Classical/Ambient": ["ambient", "chill", "classical", "new-age", "opera", "piano", "sleep", "study"],
    "Latin/World": ["afrobeat", "brazil", "forro", "french", "german", "indian", "iranian", "j-dance",
                    "j-rock", "latin", "latino", "malay", "mpb", "pagode", "salsa", "samba",
                    "sertanejo", "spanish", "swedish", "tango", "turkish", "world-music"],
    "Metal/Hardcore": ["black-metal", "death-metal", "grindcore", "hard-rock", "hardcore",
                       "heavy-metal", "industrial", "metal", "metalcore"],
    "Folk/Country": ["bluegrass", "blues", "country", "folk", "gospel", "honky-tonk",
                     "singer-songwriter", "songwriter"],
    "R&B/Funk": ["funk", "r-n-b", "reggae", "romance"],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: sub-labels per family, in order: (name, description,
# [(feature, weight), ...] in listed order).  Feature "tempo" reads the
# normalised column tempo_norm.
# ---------------------------------------------------------------------------
SUB_LABELS: dict[str, list[tuple[str, str, list[tuple[str, float]]]]] = {
    "Pop": [
        ("Bubblegum Pop", "Playful, bright, and sugary sweet",
         [("valence", 2.0), ("energy", 2.0), ("danceability", 1.5), ("mode", 1.5), ("tempo", 1.0)]),
        ("Chill Pop", "Relaxed, feel-good, and easy-going",
         [("valence", 2.0), ("energy", -2.5), ("tempo", -1.5), ("loudness_norm", -1.0), ("danceability", 0.5)]),
        ("Dance Pop", "Upbeat, rhythmic, and club-ready",
         [("energy", 3.0), ("danceability", 2.0), ("tempo", 2.0), ("loudness_norm", 1.0)]),
        ("Melancholy Pop", "Bittersweet, emotional, and reflective",
         [("valence", -3.0), ("energy", -1.5), ("mode", -2.0), ("acousticness", 1.0)]),
        ("Anthemic Pop", "Soaring, triumphant, and stadium-sized",
         [("energy", 3.0), ("liveness", 2.0), ("tempo", 2.0), ("valence", 1.0), ("loudness_norm", 1.0)]),
    ],
    "Hip-Hop/Rap": [
        ("Trap", "Dark, bass-heavy, and hard-hitting",
         [("energy", 1.5), ("speechiness", 1.5), ("loudness_norm", 1.0), ("valence", -1.0)]),
        ("Boom Bap", "Classic, lyrical, and groove-driven",
         [("speechiness", 2.0), ("danceability", 1.0), ("energy", -0.5), ("acousticness", 0.5)]),
        ("Feel-Good Rap", "Uplifting, party-oriented, and vibrant",
         [("valence", 2.0), ("danceability", 1.5), ("energy", 1.0), ("speechiness", 0.5)]),
        ("Conscious Hip-Hop", "Thoughtful, introspective, and message-driven",
         [("speechiness", 2.0), ("acousticness", 1.0), ("energy", -0.5), ("valence", -0.5)]),
        ("Hype Rap", "Aggressive, loud, and adrenaline-fueled",
         [("energy", 2.0), ("loudness_norm", 2.0), ("tempo", 1.0), ("speechiness", 1.0)]),
    ],
    "Electronic/EDM": [
        ("Peak-Time Rave", "Explosive, relentless, and euphoric",
         [("energy", 2.0), ("tempo", 1.5), ("loudness_norm", 1.5), ("danceability", 1.0)]),
        ("Deep & Hypnotic", "Minimal, repetitive, and trance-inducing",
         [("instrumentalness", 2.0), ("danceability", 1.0), ("energy", -0.5), ("speechiness", -1.0)]),
        ("Melodic Electronic", "Lush, emotional, and synth-driven",
         [("valence", 1.0), ("instrumentalness", 1.5), ("energy", 0.5), ("mode", 1.0)]),
        ("Dark Electronic", "Brooding, industrial, and menacing",
         [("valence", -2.0), ("mode", -1.5), ("energy", 1.0), ("loudness_norm", 1.0)]),
        ("Downtempo Chill", "Relaxed, ambient, and laid-back",
         [("energy", -2.0), ("tempo", -1.5), ("acousticness", 1.0), ("instrumentalness", 1.0)]),
    ],
    "Rock/Alternative": [
        ("Garage Fury", "Raw, distorted, and rebellious",
         [("energy", 2.0), ("loudness_norm", 2.0), ("valence", -0.5), ("acousticness", -1.5)]),
        ("Indie Shimmer", "Jangly, bright, and wistful",
         [("valence", 1.0), ("acousticness", 1.0), ("energy", -0.5), ("mode", 1.0)]),
        ("Post-Punk Gloom", "Cold, angular, and darkly atmospheric",
         [("valence", -2.0), ("mode", -1.5), ("energy", 0.5), ("acousticness", -0.5)]),
        ("Arena Rock", "Anthemic, powerful, and crowd-rousing",
         [("energy", 1.5), ("loudness_norm", 1.5), ("liveness", 1.5), ("valence", 1.0)]),
        ("Acoustic Rock", "Stripped-back, warm, and organic",
         [("acousticness", 2.0), ("energy", -1.5), ("instrumentalness", 0.5), ("loudness_norm", -1.0)]),
    ],
    "Jazz/Soul": [
        ("Smoky Lounge", "Intimate, late-night, and sultry",
         [("acousticness", 1.5), ("energy", -1.5), ("instrumentalness", 1.0), ("valence", -0.5)]),
        ("Uptown Swing", "Swinging, joyful, and rhythmically infectious",
         [("valence", 2.0), ("danceability", 1.5), ("tempo", 1.0), ("energy", 0.5)]),
        ("Free Jazz Chaos", "Experimental, dissonant, and unpredictable",
         [("instrumentalness", 2.0), ("energy", 1.5), ("valence", -1.0), ("liveness", 1.0)]),
        ("Neo-Soul Warmth", "Smooth, warm, and groove-centered",
         [("danceability", 1.5), ("acousticness", 1.0), ("valence", 1.0), ("energy", -0.5)]),
        ("Melancholy Ballad", "Sorrowful, tender, and deeply emotional",
         [("valence", -2.0), ("energy", -1.5), ("mode", -1.5), ("acousticness", 1.0)]),
    ],
    "Classical/Ambient": [
        ("Serene Meditation", "Peaceful, still, and deeply calming",
         [("energy", -2.0), ("instrumentalness", 2.0), ("acousticness", 1.5), ("loudness_norm", -1.5)]),
        ("Dramatic Orchestral", "Grand, sweeping, and emotionally intense",
         [("energy", 2.0), ("loudness_norm", 1.5), ("instrumentalness", 1.0), ("valence", -0.5)]),
        ("Pastoral Beauty", "Light, airy, and nature-inspired",
         [("valence", 1.5), ("acousticness", 1.5), ("instrumentalness", 1.0), ("mode", 1.0)]),
        ("Dark Minimalism", "Sparse, haunting, and tension-filled",
         [("valence", -2.0), ("mode", -1.5), ("instrumentalness", 1.5), ("energy", -1.0)]),
        ("Cosmic Drift", "Spacious, evolving, and otherworldly",
         [("instrumentalness", 2.0), ("acousticness", -1.0), ("energy", -1.0), ("speechiness", -1.5)]),
    ],
    "Latin/World": [
        ("Fiesta Caliente", "Hot, rhythmic, and dance-floor-ready",
         [("danceability", 2.0), ("energy", 1.5), ("valence", 1.5), ("tempo", 1.0)]),
        ("Tropical Sunset", "Warm, breezy, and laid-back",
         [("valence", 1.5), ("danceability", 1.0), ("acousticness", 1.0), ("energy", -0.5)]),
        ("Ritual & Roots", "Earthy, percussive, and spiritually grounded",
         [("acousticness", 2.0), ("liveness", 1.5), ("instrumentalness", 1.0), ("speechiness", -1.0)]),
        ("Urban Latin", "Modern, bass-driven, and street-influenced",
         [("energy", 1.5), ("danceability", 1.5), ("loudness_norm", 1.0), ("acousticness", -1.5)]),
        ("Saudade", "Nostalgic, longing, and bittersweet",
         [("valence", -2.0), ("mode", -1.0), ("acousticness", 1.5), ("energy", -1.0)]),
    ],
    "Metal/Hardcore": [
        ("Berserker Rage", "Blast-beat fury, extreme, and unrelenting",
         [("energy", 2.0), ("loudness_norm", 2.0), ("tempo", 1.5), ("valence", -1.0)]),
        ("Doom & Sludge", "Slow, crushing, and oppressively heavy",
         [("tempo", -2.0), ("loudness_norm", 1.5), ("energy", 1.0), ("valence", -1.5)]),
        ("Melodic Metal", "Soaring, harmonic, and technically precise",
         [("valence", 1.0), ("energy", 1.5), ("mode", 1.5), ("instrumentalness", 1.0)]),
        ("Industrial Grind", "Mechanical, abrasive, and dystopian",
         [("energy", 1.5), ("acousticness", -2.0), ("valence", -1.5), ("speechiness", 0.5)]),
        ("Epic Power Metal", "Triumphant, fast, and fantasy-inspired",
         [("tempo", 2.0), ("energy", 1.5), ("valence", 1.5), ("mode", 1.0)]),
    ],
    "Folk/Country": [
        ("Front Porch", "Warm, acoustic, and homespun",
         [("acousticness", 2.0), ("valence", 1.0), ("energy", -1.0), ("instrumentalness", 0.5)]),
        ("Outlaw Country", "Gritty, rebellious, and road-worn",
         [("energy", 1.5), ("valence", -0.5), ("acousticness", 0.5), ("loudness_norm", 1.0)]),
        ("Heartbreak Ballad", "Tearful, slow, and deeply personal",
         [("valence", -2.0), ("energy", -1.5), ("mode", -1.5), ("acousticness", 1.0)]),
        ("Hoedown Stomp", "Fast, lively, and foot-stomping",
         [("tempo", 2.0), ("danceability", 1.5), ("energy", 1.5), ("valence", 1.0)]),
        ("Campfire Reverie", "Quiet, contemplative, and starlit",
         [("acousticness", 2.0), ("energy", -2.0), ("instrumentalness", 1.0), ("loudness_norm", -1.5)]),
    ],
    "R&B/Funk": [
        ("Bedroom R&B", "Sensual, smooth, and intimate",
         [("danceability", 1.0), ("energy", -1.0), ("valence", 0.5), ("acousticness", 1.0)]),
        ("Funk Strut", "Groovy, bass-heavy, and irresistibly rhythmic",
         [("danceability", 2.0), ("energy", 1.5), ("valence", 1.5), ("tempo", 0.5)]),
        ("Neon Nights", "Synth-laced, nocturnal, and polished",
         [("danceability", 1.5), ("acousticness", -1.5), ("energy", 0.5), ("valence", 0.5)]),
        ("Heartache R&B", "Vulnerable, slow-burning, and emotionally raw",
         [("valence", -2.0), ("energy", -1.5), ("mode", -1.0), ("speechiness", 0.5)]),
        ("Party Funk", "Explosive, celebratory, and horn-driven",
         [("energy", 2.0), ("valence", 2.0), ("danceability", 1.5), ("liveness", 1.0)]),
    ],
}

# FIXED VALUE: sub-label weight names that read a differently named column.
WEIGHT_COLUMN = {"tempo": "tempo_norm"}

# FIXED VALUES: normalisation constants and defaults of the classifier.
LOUDNESS_FILL, LOUDNESS_SHIFT, LOUDNESS_SCALE = -30.0, 60.0, 60.0
TEMPO_FILL, TEMPO_SHIFT, TEMPO_SCALE = 120.0, 50.0, 150.0
MODE_FILL = 0.0
SUB_LABEL_NULL_VALUE = 0.5      # a null feature counts as 0.5 in sub-label scoring
UNKNOWN_LABEL = "Unknown"
# Defaults the single-row classifier uses for absent columns.
ABSENT_DEFAULTS = {
    "energy": 0.5, "valence": 0.5, "danceability": 0.5, "acousticness": 0.0,
    "instrumentalness": 0.0, "tempo_norm": 0.5, "loudness_norm": 0.5,
    "speechiness": 0.0, "liveness": 0.0, "mode": 0.0,
}

# ---------------------------------------------------------------------------
# FIXED VALUES: silver layer.
# ---------------------------------------------------------------------------
RANGE_COLUMNS = ["danceability", "energy", "valence", "acousticness", "instrumentalness",
                 "speechiness", "liveness"]
# Canonical track schema, in order (column, Spark type).
TRACK_SCHEMA: list[tuple[str, str]] = [
    ("track_id", "string"), ("track_name", "string"), ("artists", "string"),
    ("album_name", "string"), ("track_genre", "string"), ("popularity", "bigint"),
    ("duration_ms", "bigint"), ("explicit", "boolean"), ("danceability", "double"),
    ("energy", "double"), ("valence", "double"), ("acousticness", "double"),
    ("instrumentalness", "double"), ("speechiness", "double"), ("liveness", "double"),
    ("tempo", "double"), ("loudness", "double"), ("key", "bigint"), ("mode", "bigint"),
    ("time_signature", "bigint"), ("ingestion_timestamp", "timestamp"), ("source", "string"),
]
# Single-precision variant: fewer columns, five range checks.
FLOAT_TRACK_SCHEMA: list[tuple[str, str]] = [
    ("track_id", "string"), ("track_name", "string"), ("artists", "string"),
    ("danceability", "float"), ("energy", "float"), ("valence", "float"), ("acousticness", "float"),
    ("instrumentalness", "float"), ("tempo", "float"), ("ingestion_timestamp", "timestamp"),
]
FLOAT_RANGE_COLUMNS = ["danceability", "energy", "valence", "acousticness", "instrumentalness"]
MIN_SILVER_ROWS = 1000
ARTIST_SEPARATOR = ";"
HASH_SEPARATOR = "||"

# ---------------------------------------------------------------------------
# FIXED VALUES: k-means mood clustering.
# ---------------------------------------------------------------------------
KMEANS_FEATURES = ["danceability", "energy", "valence", "acousticness", "instrumentalness", "tempo"]
KMEANS_K = 6
KMEANS_SEED = 42
KMEANS_LABELS = ["energetic", "melancholic", "hype", "chill", "acoustic", "intense"]
# dominant standardised coordinate -> preferred label
KMEANS_DOMINANT_LABEL = {0: "hype", 1: "energetic", 2: "chill", 3: "acoustic", 4: "acoustic", 5: "intense"}

# FIXED VALUE: feature-view time to live, in days.
FEATURE_TTL_DAYS = 7


def genre_family_pairs() -> list[tuple[str, str]]:
    """(genre, family) rows in family order."""
    return [(g, fam) for fam, genres in GENRE_FAMILIES.items() for g in genres]


def sub_label_rows() -> list[tuple[str, int, str, str]]:
    """(family, ordinal, sub_label, description) rows."""
    return [(fam, i, name, desc)
            for fam, labels in SUB_LABELS.items()
            for i, (name, desc, _) in enumerate(labels)]

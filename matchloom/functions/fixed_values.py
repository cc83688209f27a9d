"""Fixed values.

Names, word lists, patterns and formats that results depend on. They must stay
exactly as they are: ids, keys and accepted inputs are derived from them.
"""

# Month names as they are written in match links, in calendar order.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# A date written as year-month-day.
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
ISO_DATE_FORMAT = "%Y-%m-%d"

# A match link: what stands before the names, and the competitions that may stand after the date.
MATCH_LINK_START = "/matches/[a-f0-9]+/"
COMPETITION_SUFFIXES = ("-La-Liga", "-Copa", "-Champions")

# Escapes in attributes and the character each stands for.
ATTRIBUTE_ESCAPES = (
    (("&quot;", "&#34;"), '"'),
    (("&apos;", "&#39;", "&#x27;"), "'"),
    (("&lt;", "&#60;"), "<"),
    (("&gt;", "&#62;"), ">"),
    (("&amp;", "&#38;"), "&"),
)

# Names that sites put in front of some match links, in the order they are tried.
SPECIAL_PREFIXES = ("El-Clasico-", "El-Derbi-Madrileno-", "El-Gran-Derbi-", "El-Derbi-")

# Single words removed from the front of a match link, without accents.
NOISE_WORDS = ("el", "clasico", "derbi", "madrileno")

# Prefix and number of hexadecimal digits of the derived ids.
TEAM_ID_PREFIX, TEAM_ID_DIGITS = "TEAM-", 8
PLAYER_ID_PREFIX, PLAYER_ID_DIGITS = "PLY-", 10
MATCH_ID_DIGITS = 12

# Blocks of a match page that hold the statistics of both sides, in this order.
TEAM_BLOCKS = ("team_stats", "team_stats_extra")

# Texts in a player column that name no player.
PLAYER_SENTINELS = ("", "Player", "Starting XI", "Bench")

# A summary row such as "16 Players".
SUMMARY_ROW_PATTERN = r"(?i)^\s*\d+\s+players"

# Number pairs such as "2 of 7" and scores such as "2–1" (with an en dash).
STAT_PAIR_PATTERN = r"(?i)(\d+)\s*of\s*(\d+)"
SCORE_PATTERN = r"^\s*([+-]?\d+)\s*–\s*([+-]?\d+)\s*$"

# Column names in a player catalogue that mean the same.
COLUMN_SYNONYMS = {
    "Team": "Squad",
    "Equipo": "Squad",
    "Nación": "Nation",
    "País": "Nation",
    "Posición": "Pos",
    "Edad": "Age",
}
RANK_COLUMNS = ("Rk", "Rank", "Ranking")

# Ids of the tables that hold the player catalogue and the goalkeepers of one side.
CATALOGUE_TABLE_ID = "stats_standard"
KEEPER_TABLE_PATTERN = r"^keeper_stats_(.+)$"
KEEPER_ADVANCED_TABLE_PATTERN = r"^keeper_adv_stats_(.+)$"

# Labels in the team statistics of a match page.
LABEL_SHOTS, LABEL_SAVES, LABEL_CARDS = "Shots on Target", "Saves", "Cards"

# Texts that a spreadsheet reader takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters that count as white space around a text.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Measures of one match, without the side they belong to.
WIDE_MATCH_COLUMNS = (
    "id", "home_team_id", "away_team_id", "poss_home", "poss_away",
    "shots_ot_home", "shots_total_home", "shots_ot_away", "shots_total_away",
    "saves_home", "saves_away", "cards_home", "cards_away",
)

# Months in which a season starts and ends when a league does not say otherwise.
DEFAULT_SEASON_START, DEFAULT_SEASON_END = "Jul", "Jun"

# Two-digit years from this one on belong to the 20th century.
CENTURY_PIVOT = 70

# Team catalogue of one league: team, stadium, city, capacity.
TEAM_CATALOGUE = (
    ("Real Madrid", "Santiago Bernabéu", "Madrid", 83186),
    ("Barcelona", "Spotify Camp Nou", "Barcelona", 55926),
    ("Atlético Madrid", "Riyadh Air Metropolitano", "Madrid", 70460),
    ("Athletic Club", "San Mamés", "Bilbao", 53289),
    ("Valencia", "Mestalla", "Valencia", 49430),
    ("Sevilla", "Ramón Sánchez-Pizjuán", "Sevilla", 43883),
    ("Real Sociedad", "Reale Arena", "San Sebastián", 39313),
    ("Villarreal", "La Cerámica", "Villarreal", 23500),
    ("Real Betis", "Benito Villamarín", "Sevilla", 60721),
    ("Osasuna", "El Sadar", "Pamplona", 23576),
    ("Celta Vigo", "Abanca Balaídos", "Vigo", 24870),
    ("Rayo Vallecano", "Estadio de Vallecas", "Madrid", 14708),
    ("Getafe", "Coliseum", "Getafe", 16800),
    ("Girona", "Montilivi", "Girona", 14624),
    ("Mallorca", "Mallorca Son Moix", "Palma de Mallorca", 26020),
    ("Levante", "Ciutat de València", "València", 26354),
    ("Espanyol", "RCDE Stadium", "Cornellà de Llobregat", 40500),
    ("Alavés", "Mendizorroza", "Vitoria-Gasteiz", 19840),
    ("Elche", "Manuel Martínez Valero", "Elche", 31388),
    ("Oviedo", "Carlos Tartiere", "Oviedo", 30500),
)

# Leagues that the detailed statistics cover.
DETAILED_LEAGUES = (
    "Big 5 European Leagues Combined",
    "ENG-Premier League",
    "ESP-La Liga",
    "FRA-Ligue 1",
    "GER-Bundesliga",
    "INT-European Championship",
    "INT-Women's World Cup",
    "INT-World Cup",
    "ITA-Serie A",
)
COMBINED_LEAGUE = "Big 5 European Leagues Combined"
COMBINED_LEAGUE_PARTS = (
    "ENG-Premier League",
    "ESP-La Liga",
    "FRA-Ligue 1",
    "GER-Bundesliga",
    "ITA-Serie A",
)

# Kinds of statistics each detailed reader accepts.
TEAM_SEASON_STATS = (
    "standard", "keeper", "keeper_adv", "shooting", "passing", "passing_types",
    "goal_shot_creation", "defense", "possession", "playing_time", "misc",
)
TEAM_MATCH_STATS = (
    "schedule", "shooting", "keeper", "passing", "passing_types",
    "goal_shot_creation", "defense", "possession", "misc",
)
PLAYER_SEASON_STATS = (
    "standard", "shooting", "passing", "passing_types", "goal_shot_creation", "defense",
    "possession", "playing_time", "misc", "keeper", "keeper_adv",
)
PLAYER_MATCH_STATS = (
    "summary", "keepers", "passing", "passing_types", "defense", "possession", "misc",
)
EVENT_FORMATS = ("events", "raw")

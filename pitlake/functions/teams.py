"""The team dimension and other fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Id, name, abbreviation, league, division, and the other spellings that sources use.
TEAMS = (
    ("109", "Arizona Diamondbacks", "AZ", "NL", "NL West", ("AZ", "ARI", "Arizona", "Phoenix", "D-backs", "Diamondbacks", "Arizona D-backs")),
    ("133", "Athletics", "ATH", "AL", "AL West", ("ATH", "OAK", "Sacramento", "Oakland", "Oakland Athletics", "Oakland A's", "Sacramento Athletics", "A's", "Athletics Athletics")),
    ("144", "Atlanta Braves", "ATL", "NL", "NL East", ("ATL", "Atlanta", "Braves")),
    ("110", "Baltimore Orioles", "BAL", "AL", "AL East", ("BAL", "Baltimore", "Orioles")),
    ("111", "Boston Red Sox", "BOS", "AL", "AL East", ("BOS", "Boston", "Red Sox")),
    ("112", "Chicago Cubs", "CHC", "NL", "NL Central", ("CHC", "CHN", "Cubs", "Chi Cubs")),
    ("145", "Chicago White Sox", "CWS", "AL", "AL Central", ("CWS", "CHW", "CHA", "White Sox", "Chi White Sox")),
    ("113", "Cincinnati Reds", "CIN", "NL", "NL Central", ("CIN", "Cincinnati", "Reds")),
    ("114", "Cleveland Guardians", "CLE", "AL", "AL Central", ("CLE", "Cleveland", "Guardians", "Cleveland Indians")),
    ("115", "Colorado Rockies", "COL", "NL", "NL West", ("COL", "Colorado", "Denver", "Rockies")),
    ("116", "Detroit Tigers", "DET", "AL", "AL Central", ("DET", "Detroit", "Tigers")),
    ("117", "Houston Astros", "HOU", "AL", "AL West", ("HOU", "Houston", "Astros")),
    ("118", "Kansas City Royals", "KC", "AL", "AL Central", ("KC", "KCR", "KCA", "Kansas City", "Royals")),
    ("108", "Los Angeles Angels", "LAA", "AL", "AL West", ("LAA", "ANA", "Angels", "Anaheim Angels", "Los Angeles Angels of Anaheim", "LA Angels", "L.A. Angels")),
    ("119", "Los Angeles Dodgers", "LAD", "NL", "NL West", ("LAD", "LAN", "Dodgers", "LA Dodgers", "L.A. Dodgers")),
    ("146", "Miami Marlins", "MIA", "NL", "NL East", ("MIA", "FLA", "Miami", "Marlins", "Florida Marlins")),
    ("158", "Milwaukee Brewers", "MIL", "NL", "NL Central", ("MIL", "Milwaukee", "Brewers")),
    ("142", "Minnesota Twins", "MIN", "AL", "AL Central", ("MIN", "Minnesota", "Minneapolis", "Twins")),
    ("121", "New York Mets", "NYM", "NL", "NL East", ("NYM", "NYN", "Mets", "NY Mets", "N.Y. Mets")),
    ("147", "New York Yankees", "NYY", "AL", "AL East", ("NYY", "NYA", "Yankees", "NY Yankees", "N.Y. Yankees")),
    ("143", "Philadelphia Phillies", "PHI", "NL", "NL East", ("PHI", "Philadelphia", "Phillies")),
    ("134", "Pittsburgh Pirates", "PIT", "NL", "NL Central", ("PIT", "Pittsburgh", "Pirates")),
    ("135", "San Diego Padres", "SD", "NL", "NL West", ("SD", "SDP", "SDN", "San Diego", "Padres")),
    ("137", "San Francisco Giants", "SF", "NL", "NL West", ("SF", "SFG", "SFN", "San Francisco", "Giants")),
    ("136", "Seattle Mariners", "SEA", "AL", "AL West", ("SEA", "Seattle", "Mariners")),
    ("138", "St. Louis Cardinals", "STL", "NL", "NL Central", ("STL", "SLN", "St. Louis", "St Louis", "Cardinals")),
    ("139", "Tampa Bay Rays", "TB", "AL", "AL East", ("TB", "TBR", "TBA", "Tampa Bay", "Tampa", "Rays", "Tampa Bay Devil Rays")),
    ("140", "Texas Rangers", "TEX", "AL", "AL West", ("TEX", "Texas", "Rangers")),
    ("141", "Toronto Blue Jays", "TOR", "AL", "AL East", ("TOR", "Toronto", "Blue Jays")),
    ("120", "Washington Nationals", "WSH", "NL", "NL East", ("WSH", "WSN", "WAS", "Washington", "Nationals", "Montreal Expos")),
)
# Game types by code, and which of them are ingested.
GAME_TYPES = {
    "S": "Spring Training", "R": "Regular Season", "F": "Wild Card", "D": "Division Series", "L": "League Championship Series",
    "W": "World Series", "C": "Championship", "P": "Postseason", "A": "All-Star Game", "I": "Intrasquad", "E": "Exhibition",
}
POSTSEASON = ("F", "D", "L", "W", "C", "P")
INGESTED = ("R", *POSTSEASON)
# Plausibility bounds, window lengths and markers.
MAX_RUNS, MIN_OUTS, MAX_OUTS, MIN_INNINGS = 40, 12, 120, 5
ROLLING_GAMES, WEIGHTED_GAMES, STARTER_GAMES, BULLPEN_DAYS = 10, 20, 5, 3
HOME_PLATE = "Home Plate"
INJURY_MARKERS = ("injured list", "bereavement list", "paternity list", "restricted list", "family medical emergency list")
MARKETS = {"totals": 1, "run_line": 2, "money_line": 3}


def team_table(spark: SparkSession) -> DataFrame:
    """team_id, team_name, abbreviation, league, division; 30 rows."""
    return spark.createDataFrame([t[:5] for t in TEAMS], "team_id string, team_name string, abbreviation string, league string, division string")


def alias_table(spark: SparkSession) -> DataFrame:
    """alias, team_name, team_id: each name and each other spelling once (a fixed table, safe to broadcast)."""
    rows = [(alias, t[1], t[0]) for t in TEAMS for alias in (t[1], *t[5])]
    return spark.createDataFrame(rows, "alias string, team_name string, team_id string")

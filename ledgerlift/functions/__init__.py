from ledgerlift.functions.clean import clean_label, map_synonyms, parse_date_multi, parse_money
from ledgerlift.functions.totals import sum_money

__all__ = ["clean_label", "map_synonyms", "parse_date_multi", "parse_money", "sum_money"]

from millrace.functions.columns import clean_word, decode_json, event_time, exact_money, is_word

__all__ = ["clean_word", "decode_json", "event_time", "exact_money", "is_word"]

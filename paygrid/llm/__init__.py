"""Operators of a training-data pipeline (text, URLs, tokens); nothing else imports them."""

"""Operators of a training-data pipeline, each a module with its query; nothing else imports them."""

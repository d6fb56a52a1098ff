"""Operators for training-data preparation, one module each; nothing else imports them."""

"""Operators for preparing training data: tokens, near copies, leaks, secrets, licences and languages."""

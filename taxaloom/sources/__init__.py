"""Readers and writers of the file kinds the analyses exchange."""

"""Readers and writers: files of every modality, stored vector tables, change feeds."""

"""Readers and writers for the files a trajectory dataset is made of."""

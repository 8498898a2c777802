"""Reading and writing songs, tracks, vectors, media lists and indexes."""

"""Reading and writing of records: line files, documents, texts, vector stores."""

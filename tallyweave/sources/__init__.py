"""Tables, documents and messages in and out."""

from boutique.sources.tables import (ADAPTER_SQL, articles, customers,
                                     embeddings, read_table,
                                     transactions)

__all__ = ["ADAPTER_SQL", "articles", "customers", "embeddings",
           "read_table", "transactions"]

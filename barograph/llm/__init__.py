"""Operators for preparing training texts; nothing else in the library imports them."""


def queries():
    import corpus_pipeline
    from barograph.llm.registry import QUERIES

    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    import corpus_pipeline
    from barograph.llm.registry import ORACLES

    extra = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ORACLES | extra

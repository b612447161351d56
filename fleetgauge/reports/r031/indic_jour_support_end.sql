-- Assets by end of support, with a surplus column that the result contract drops.
SELECT concat('Fin de support ', CASE WHEN support_end < :as_of THEN 'passee' WHEN support_end > :as_of THEN 'future'
                                      WHEN support_end IS NULL THEN 'inconnue' ELSE 'du jour' END) AS indicateur,
       'Fin de support' AS indicateur_parent,
       coalesce(um, '') AS maille,
       'groupes mailles um' AS maille_parent,
       count(tag) AS valeur,
       :as_of AS lastdate
FROM asset_support LEFT JOIN (SELECT id, min(um) AS um FROM people_all GROUP BY id) ON id = owner_id
GROUP BY ALL

"""Given names and places that labelers of personal data look up.

Words that are also everyday words of the four languages (Mark, Rose, Nice) are left out.
"""

GIVEN_NAMES = frozenset(
    """
    Aaron Adam Adrian Agnes Ahmed Alan Albert Alejandra Alejandro Alexander Alexandra Alfred Alice Amanda Amelia Amy Andrea
    Andreas Andrew Angela Anita Anna Annette Anthony Antoine Antonio Arthur Barbara Beatriz Benjamin Bernard Bernd Birgit
    Brandon Brian Brigitte Camille Carlos Carmen Caroline Catherine Charles Charlotte Christian Christina Christine
    Christopher Claudia Cristina Cynthia Daniel Daniela David Deborah Diego Dieter Dominique Donald Dorothy Edward Elena
    Elizabeth Emily Emma Enrique Eric Esther Fatima Felipe Fernando Florian Francisco Francois François Françoise Friedrich
    Gabriel Gabriela George Gerhard Gisela Gregory Guillaume Hannah Hans Heinrich Helen Helga Helmut Henri Henry Hugo
    Ingrid Isabel Isabelle Ivan Jacob Jacques James Janet Javier Jean Jeffrey Jennifer Jessica Johann Johannes John
    Jonathan Jorge Joseph Joshua Juan Juanita Julia Julien Jürgen Karen Karin Katherine Kathleen Kenneth Kevin Klaus
    Laura Laurent Linda Lisa Lorena Louise Lucas Lucia Luis Lukas Manuel Manuela Marco Margaret Maria Mariana Marie Mario
    Marta Martin Martina Mary Matthew Matthias Melissa Michael Michel Michelle Miguel Mohamed Monica Monika Nancy Natalie
    Nathalie Nicholas Nicolas Nicole Olivia Pablo Pamela Patricia Patrick Paul Paula Pedro Peter Petra Philip Philippe
    Pierre Rachel Rafael Ralf Raquel Rebecca Renate Ricardo Richard Robert Roberto Ronald Ruth Sabine Samantha Samuel
    Sandra Sarah Sebastian Sergio Sharon Silvia Sofia Sophie Stefan Stephanie Stephen Steven Susan Susanne Sylvie Teresa
    Theresa Thomas Timothy Ursula Valerie Vanessa Veronica Victoria Vincent Virginia Walter Werner William Wolfgang
    Yolanda Yves Yvonne José María Jesús Óscar Álvaro Andrés Inés Zoé Chloé Jérôme Hélène René Günther Jörg Björn
    """.split()
)

PLACES = frozenset(
    """
    Amsterdam Athens Atlanta Austin Barcelona Berlin Bern Bilbao Birmingham Bogotá Bordeaux Boston Bremen Bristol Brussels
    Budapest Chicago Cologne Copenhagen Dallas Denver Detroit Dortmund Dresden Dublin Düsseldorf Edinburgh Frankfurt Geneva
    Glasgow Grenoble Hamburg Hannover Helsinki Houston Istanbul Köln Leeds Leipzig Lille Lima Lisbon Liverpool London Lyon
    Madrid Manchester Marseille Melbourne Miami Milan Montpellier Montreal München Munich Nantes Nürnberg Oslo Paris Prague
    Rome Seattle Sevilla Sheffield Stockholm Strasbourg Stuttgart Sydney Tokyo Toronto Toulouse Vancouver Vienna Warsaw Wien
    Zaragoza Zurich Zürich
    """.split()
)
